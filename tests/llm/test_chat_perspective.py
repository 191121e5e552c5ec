import random

import pytest

from hirelens.llm import chat_perspective as cp

SCHEMA = "conv_id bigint, turn bigint, role string, text string, speaker string, part int, turns string, name string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], SCHEMA)


def plain(rows, max_turns):
    """Rendered parts by plain loops: ``{(conv, speaker, part): (text, learnt texts)}``."""
    conversations = {}
    for conv, turn, role, text in rows:
        name = "_".join((role or "").split(" ")).strip("_") if role and role.strip() else ""
        conversations.setdefault(conv, []).append((turn is not None, turn or 0, name, text or ""))
    made = {}
    for conv, turns in conversations.items():
        turns.sort()
        for speaker in {t[2] for t in turns} - {"", "system"}:
            for part in range(-(-len(turns) // max_turns)):
                text, learnt = "", []
                for _, _, name, said in turns[part * max_turns : (part + 1) * max_turns]:
                    who = "assistant" if name == speaker else name if name == "system" else f"user name={name}" if name else "user"
                    text += f"<|im_start|>{who}\n"
                    if name == speaker:
                        learnt.append((len(text), len(text) + len(said) + len("<|im_end|>")))
                    text += f"{said}<|im_end|>\n"
                made[conv, speaker, part] = (text, learnt)
    return made


@pytest.mark.parametrize("max_turns", [256, 3])
def test_same_as_plain_loops(spark, max_turns):
    r = random.Random(max_turns)
    rows = [(c, t, r.choice(["ann", "bob", "cy", "system"]), f"text {t} é日" * r.randint(0, 3))
            for c in range(20) for t in range(r.randint(1, 12))]
    made = cp.perspectives(table(spark, rows), max_turns)
    assert made.columns == ["conv_id", "speaker", "part", "n_turns", "rendered", "loss_spans", "n_loss_chars"]
    got = {(x.conv_id, x.speaker, x.part): (x.rendered, [(s.start, s.end) for s in x.loss_spans]) for x in made.collect()}
    assert got == plain(rows, max_turns)
    for x in made.collect():
        assert x.n_loss_chars == sum(s.end - s.start for s in x.loss_spans)
        assert all(x.rendered[s.start : s.end].endswith("<|im_end|>") for s in x.loss_spans)


@pytest.mark.parametrize("max_turns", [256, 2])
def test_odd_rows(spark, max_turns):
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", ""), (1, None, "user", "first"), (2, 0, None, "nobody"),
            (2, 1, "  ", "blank"), (3, 0, "system", "only"), (None, 5, "user", "no id"), (None, 4, "bot", "none"), (None, 6, "bot", "x"),
            (4, 0, "Ann Lee", "word " * 50_000), (4, 0, "user", "tie"), (4, 0, "user", "a tie")]
    made = cp.perspectives(table(spark, rows), max_turns).collect()
    got = {(x.conv_id, x.speaker, x.part): (x.rendered, [(s.start, s.end) for s in x.loss_spans]) for x in made}
    assert got == plain(rows, max_turns) and len(got) == len(made)
    assert not {c for c, _, _ in got} & {2, 3}
    assert cp.perspectives(table(spark, [])).count() == 0


def test_one_very_long_conversation(spark):
    rows = [(c, t, "ann" if t % 2 else "bob", f"t{t}") for c, n in ((1, 2000), (2, 4)) for t in range(n)]
    made = cp.perspectives(table(spark, rows), 100).collect()
    assert max(x.n_turns for x in made) == 100 and sum(x.n_turns for x in made) == 2 * 2004
    text = "".join(x.rendered for x in sorted((x for x in made if x.conv_id == 1 and x.speaker == "bob"), key=lambda x: x.part))
    assert text == plain(rows, 10_000)[1, "bob", 0][0]


def test_no_python_on_the_main_path(spark):
    plan = cp.perspectives(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
