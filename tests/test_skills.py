import random

import pytest
from fixtures import POSTINGS, SKILL_IDS, SKILLS, SURFACES, as_set, rows

from hirelens import schemas
from hirelens.operators import lookup, skills
from hirelens.operators.skills import dedupe_gazetteer, extract_skills, new_links, new_skills
from hirelens.operators.staging import stage as staged_rows


# What the cases below are about: case, white space, tokens, joined and separate spellings.
EDGES = ["Go", "Kafka", "Rust", "Delta Lake", "Flink", "HyperLog", "Hyper Log", "event-driven", "C", "D", "go", " "]


def gazetteer(spark, names=SKILLS):
    return dedupe_gazetteer(spark.createDataFrame(list(enumerate(names)), "pos long, skill string"))


def texts(spark, items):
    return spark.createDataFrame(items, "job_id long, description_raw string")


def postings(spark):
    return texts(spark, [(i + 1, p[1]) for i, p in enumerate(POSTINGS)])


def no_skills(spark):
    return spark.createDataFrame([], schemas.SKILLS)


def test_gazetteer_keeps_first_spelling(spark):
    got = as_set(gazetteer(spark, [" The", "of the", "the ", "", "\t", "Of The", "scikit-learn", "C++"]))
    assert got == {("The", "the", 1), ("of the", "of the", 2), ("scikit-learn", "scikit-learn", 3), ("C++", "c++", 1)}


def test_the_postings(spark):
    found = extract_skills(postings(spark), gazetteer(spark))
    assert as_set(found, "job_id", "surface") == {(i, s) for i, names in SURFACES.items() for s in names}


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, set()),
        ("", set()),
        ("  ", set()),
        ("kafka and KAFKA", {"kafka", "KAFKA"}),
        ("HyperLog", {"HyperLog"}),
        ("Delta  Lake", set()),
        ("Delta\nLake", set()),
        ("delta lake", {"delta lake"}),
        ("Rust/Go", {"Rust", "Go"}),
        ("C. and c", {"C", "c"}),
        ("Event-Driven", {"Event-Driven"}),
        ("rust_3 rusty Rust", {"Rust"}),
        ("delta lake flink", {"delta lake", "flink"}),
        ("C&D and C & D", {"C", "D"}),
        ("C.D. or X.C. at C.Corp", set()),
        ("C3-compatible, 3-C, C-3, Go-2", set()),
        ("CI/C, T-Go, C-D, C++/C", {"C", "Go", "D"}),
    ],
)
def test_edges(spark, text, expected):
    found = extract_skills(texts(spark, [(1, text)]), gazetteer(spark, EDGES))
    assert as_set(found, "surface") == {(s,) for s in expected}


PROGRAMMING = ["C", "C++", "C#", "D", ".NET", "NET", "R", "Node", "Node.js", "Go"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("We use C++ and C#", {"C++", "C#"}),
        ("C++, C# and C.", {"C++", "C#", "C"}),
        ("C++17 or c#8", {"C++", "c#"}),
        ("C+ or C+D", {"C", "D"}),
        ("C#Go", {"C#", "Go"}),
        (".NET, ASP.NET (.NET)", {".NET"}),
        ("It ends.NET begins", {"NET"}),
        ("You know R. Then Go.", {"R", "Go"}),
        ("Node.js or Node", {"Node.js", "Node"}),
        ("We like Node.Go on", {"Node", "Go"}),
        ("D3.js, R&D, C/C++", {"C", "C++"}),
        ("...NET", {"NET"}),
    ],
)
def test_signs_that_belong_to_a_name(spark, text, expected):
    found = extract_skills(texts(spark, [(1, text)]), gazetteer(spark, PROGRAMMING))
    assert as_set(found, "surface") == {(s,) for s in expected}


def token_spans(text):
    """Tokens by the written rule, character by character."""
    at = lambda k: text[k] if 0 <= k < len(text) else " "
    word = lambda k: at(k).isalnum() or at(k) == "_"
    joins_words = lambda k: word(k + 1) and (
        at(k) == "&" or at(k) == "-" and (at(k - 1).isdigit() or at(k + 1).isdigit())
        or at(k) == "." and not (at(k - 1).islower() and at(k + 1).isupper()))
    spans, i = [], 0
    while i < len(text):
        end = i + 1
        if text[i].isspace():
            i = end
            continue
        dots = 0
        while text[i].isalpha() and dots < 10 and at(end) == "." and at(end + 1).isalpha():
            end, dots = end + 2, dots + 1
        lead = at(i) == "." and at(i + 1).isalpha() and not (word(i - 1) or at(i - 1) in ".)]")
        if dots and at(end) == ".":
            end += 1
        elif dots:
            while word(end):
                end += 1
        elif word(i) or lead:
            while word(end):
                end += 1
            joins = 0
            while joins < 10 and joins_words(end):
                end, joins = end + 2, joins + 1
                while word(end):
                    end += 1
            signs = 0
            while at(end + signs) == (at(end) if at(end) in "+#" else None):
                signs += 1
            end += 0 if signs == 1 and at(end) == "+" and word(end + 1) else signs
        spans.append((i, end))
        i = end
    return spans


def naive_scan(items, phrases):
    """Every token-aligned stretch of text that is a phrase in any case."""
    keys = {p.lower() for p in phrases}
    found = set()
    for job_id, text in items:
        spans = token_spans(text)
        for i, (start, _) in enumerate(spans):
            for _, end in spans[i : i + 6]:
                if text[start:end].lower() in keys:
                    found.add((job_id, text[start:end], text[start:end].lower()))
    return found


def random_case(seed):
    rng = random.Random(seed)
    words = ["a", "b", "Ab", "éa", "R", "c", "x_1", "7"]
    gaps = [" ", " ", " ", " ", "  ", "\n", "-", "+", "++", "#", "/", ".", " .", "&", ""]
    items = [(i, "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 25)))) for i in range(900)]
    return items, ["a", "a b", "a-b", "r", "éa c", "c++", "ab/a", "x_1", "a b", "a r c", "b a r"]


def test_equals_naive_scan_and_both_joins_agree(spark, monkeypatch):
    items, phrases = random_case(11)
    expected = naive_scan(items, phrases)
    assert len(expected) > 300
    assert {k.count(' ') for _, _, k in expected} == {0, 1, 2}
    df, words = texts(spark, items), gazetteer(spark, phrases)
    assert as_set(extract_skills(df, words)) == expected
    monkeypatch.setattr(skills, "PREFILTER_TOKENS", 2)
    assert as_set(extract_skills(df, words)) == expected
    # Beyond the bound only a bit set is broadcast, and runs that are no phrase never reach the salted join.
    beyond = extract_skills(df, words, spread=3, max_rows=2)
    text = beyond._jdf.queryExecution().sparkPlan().toString()
    assert "bitmap_construct_agg" in text and "_salt" in text
    assert as_set(beyond) == expected


def test_a_bit_set_of_phrases_lets_few_others_through(spark):
    phrases = spark.range(3000).selectExpr("concat('phrase ', id) AS skill_key")
    runs = spark.range(30_000).selectExpr("id", "concat('phrase ', id) AS skill_key")
    through = skills.maybe_phrases(runs, phrases, 3000)
    assert through.columns == runs.columns
    assert through.filter("id < 3000").count() == 3000 and through.filter("id >= 3000").count() < 27_000 / 8
    sizes = skills.phrase_bits(phrases, 1 << 16).selectExpr("count(*)", "max(size(words))").first()
    assert tuple(sizes) == (2, 512)
    plan = through._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("long_tokens", [1, 2])
def test_long_phrases_are_found_by_their_beginning(spark, monkeypatch, long_tokens):
    items, phrases = random_case(12)
    monkeypatch.setattr(skills, "LONG_TOKENS", long_tokens)
    found = extract_skills(texts(spark, items), gazetteer(spark, phrases))
    assert as_set(found) == naive_scan(items, phrases)


def test_one_very_long_entry_adds_no_column_per_token(spark):
    long = " ".join(f"word{i}" for i in range(300))
    found = extract_skills(texts(spark, [(1, f"Go, {long.upper()} and Go"), (2, long[:-1]), (3, None)]), gazetteer(spark, ["Go", long]))
    assert as_set(found) == {(1, "Go", "go"), (1, long.upper(), long)}
    assert "_run9" not in found._jdf.queryExecution().analyzed().toString()


def test_entry_with_odd_white_space_is_stored_under_its_plain_name(spark):
    found = extract_skills(texts(spark, [(1, "Delta  Lake, delta lake")]), gazetteer(spark, ["delta  lake"]))
    assert as_set(found) == {(1, "Delta Lake", "delta lake")}
    both = extract_skills(texts(spark, [(1, "Delta  Lake, Delta Lake")]), gazetteer(spark, ["delta  lake", "Delta Lake"]))
    assert as_set(both) == {(1, "Delta Lake", "delta lake")}


def test_empty_dictionary(spark):
    assert rows(extract_skills(postings(spark), gazetteer(spark, [" "]))) == []


def test_ids_by_first_appearance(spark):
    found = extract_skills(postings(spark), gazetteer(spark))
    made = new_skills(found, no_skills(spark))
    assert as_set(made, "skill_id", "skill_raw") == set(SKILL_IDS.items())
    assert made.columns == schemas.SKILLS.fieldNames()
    assert {tuple(r) for r in made.select("confidence", "extractor_version").collect()} == {(None, "rule_v1")}


def test_later_spellings_map_to_the_first(spark):
    found = extract_skills(texts(spark, [(5, "go"), (3, "GO Go"), (4, "rust")]), gazetteer(spark, EDGES))
    made = new_skills(found, no_skills(spark))
    assert as_set(made, "skill_id", "skill_norm") == {(1, "GO"), (2, "rust")}
    links = new_links(found, made, spark.createDataFrame([], schemas.JOBS_SKILLS))
    assert as_set(links) == {(3, 1), (4, 2), (5, 1)}


def test_only_new_skills_and_links(spark):
    found = extract_skills(postings(spark), gazetteer(spark))
    stored = spark.createDataFrame(
        [(7, "x", "welding"), (9, "Forklift ", None), (8, "WELDING", None)], "skill_id long, skill_raw string, skill_norm string"
    )
    made = new_skills(found, stored)
    names = [s for s in SKILL_IDS.values() if s not in ("Welding", "forklift")]
    assert as_set(made, "skill_id", "skill_raw") == set(enumerate(names, 10))
    every = stored.unionByName(made.select(stored.columns))
    bridge = spark.createDataFrame([(1, 7), (1, 9), (99, 7)], schemas.JOBS_SKILLS)
    links = as_set(new_links(found, every, bridge))
    assert len(links) == 15 - 2
    assert (4, 7) in links and (1, 7) not in links and (2, 9) in links


def test_salted_lookup_keeps_all_rows_of_a_hot_key(spark):
    facts = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('k', id % 50)) AS name")
    table = spark.createDataFrame([("hot", 1), ("k1", 2), ("none", 3)], "name string, v int")
    for how in ("inner", "left"):
        small = lookup.lookup_join(facts, table, "name", how, small=True)
        salted = lookup.lookup_join(facts, table, "name", how, spread_by=["id"], small=False, salts=5)
        assert as_set(small, "id", "name", "v") == as_set(salted, "id", "name", "v")


def test_broadcast_bound_is_measured(spark):
    df = spark.createDataFrame([("a" * 100,)] * 10, "s string")
    assert lookup.fits_broadcast(df)
    assert not lookup.fits_broadcast(df, max_rows=9)
    assert not lookup.fits_broadcast(df, max_bytes=1000)
    assert lookup.fits_broadcast(df.limit(0))


def test_new_skills_group_the_matches_before_they_meet_the_stored_ones(spark, monkeypatch):
    found = [(2, "Go", "go"), (1, "GO", "go"), (1, "Go", "go"), (3, "Rust", "rust"), (None, "rust", "rust"), (0, "C", "c"), (0, "C", "c")]
    matches = spark.createDataFrame(found, "job_id long, surface string, skill_key string")
    staged = []
    monkeypatch.setattr(skills, "stage", lambda df, label: staged.append((label, df)) or staged_rows(df, label))
    stored = spark.createDataFrame([(7, "C", None)], "skill_id long, skill_raw string, skill_norm string")
    made = new_skills(matches, stored)
    assert as_set(made, "skill_id", "skill_raw") == {(8, "rust"), (9, "GO")}
    label, grouped = staged[0]
    assert label == "first_matches" and as_set(grouped) == {("go", 1, "GO"), ("rust", None, "rust"), ("c", 0, "C")}
    # Matches are grouped by hash on their way into the shuffle, not sorted.
    text = grouped._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(job_id" in text and text.rindex("HashAggregate") > text.rindex("SortAggregate")
