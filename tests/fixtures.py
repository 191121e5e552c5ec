"""Seven postings and a dictionary with results worked out by hand.

One posting for each thing the parsers and marts must tell apart: a range per year, a range per hour, no pay at all, one
number without a period, a posting without a date, pay in words, a posting without a place; countries given, missing
and by one part alone; phrases that overlap, signs that belong to a name, several spellings, no phrase at all.
"""

from datetime import date

# (title, description, date, location, salary); ids are 1..7 in this order.
POSTINGS = [
    ("Boilermaker", "Welding and brazing; forklift licence.", "2023-05-04", "Porto / Portugal", "€30k-€34k/year"),
    ("Night shift", "Forklift work in cold storage.", "2023-05-20", "Braga, Portugal", "EUR 18-22/hour"),
    ("Helper", "No tools needed.", "2023-07-02", "Graz", ""),
    ("Machinist", "CNC milling, welding, C++.", "2023-07-11", "Linz, OO, Austria", "£40k"),
    ("Driver", "Forklift; welding.", "", "Wien, W, Austria", "$25/hour"),
    ("Jeweller", "Brazing & welding in R.", "2023-09-30", "Faro | Portugal", "€36k-€40k per year"),
    ("Yard", "Forklift only.", "2023-09-12", "", "competitive"),
]

SKILLS = ["Welding", "Brazing", "Forklift", "Cold Storage", "CNC", "CNC milling", "C", "C++", "R", "First Aid", "Docker", "welding", " "]

SURFACES = {
    1: ["Welding", "brazing", "forklift"],
    2: ["Forklift", "cold storage"],
    4: ["C++", "CNC", "CNC milling", "welding"],
    5: ["Forklift", "welding"],
    6: ["Brazing", "R", "welding"],
    7: ["Forklift"],
}

SKILL_IDS = {1: "Welding", 2: "brazing", 3: "forklift", 4: "cold storage", 5: "C++", 6: "CNC", 7: "CNC milling", 8: "R"}


def write_postings_csv(path) -> str:
    import csv

    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(["title_raw", "description_raw", "company", "source", "post_date", "location_raw", "salary_raw",
                      "url"])
        for i, (title, text, day, place, pay) in enumerate(POSTINGS):
            out.writerow([title, text, f"Company {i}", "test", day, place, pay, f"https://example.org/{i}"])
    return str(path)


def write_skills_csv(path) -> str:
    with open(path, "w", encoding="utf-8") as f:
        f.write("skill\n" + "".join(f"{s}\n" for s in SKILLS))
    return str(path)


def month(text: str) -> date:
    return date.fromisoformat(f"{text}-01")


def rows(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


def as_set(df, *cols) -> set[tuple]:
    got = rows(df.select(*cols) if cols else df)
    assert len(got) == len(set(got))
    return set(got)
