from hypothesis import given, settings
from hypothesis import strategies as st

from assayloom.llm.chat_format import format_chats, read_chats

SCHEMA = "conv_id long, turn long, role string, text string, turns string"
TRAPS = ["</s>[INST] ok [/INST]", "\\", "\\\\[INST]", " [NEXT] ", "[ROLE] x [TEXT] y [/ROLE]", "", None, "<s> <s>", "a\nb", "$1 \\1", "[/INST]", "é" * 3]
ROLES = ["user", "assistant", "system", "tool", "[TEXT]", "", None]


def check(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(2)
    got = {r["conv_id"]: r for r in read_chats(format_chats(df)).collect()}
    want = {}
    for c, n, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert got.keys() == want.keys()
    for c, turns in want.items():
        assert [(t["role"], t["text"]) for t in got[c]["turns"]] == turns
        assert got[c]["loss_text"] == "".join(t for r, t in turns if r == "assistant")


def test_round_trip_of_traps(spark):
    rows = [(c, t, ROLES[(c * 3 + t * t) % 7], TRAPS[(c + t * 5) % 12]) for c in range(40) for t in range(c % 9)]
    rows += [(100, 0, "user", "a"), (100, 0, "user", "a"), (100, None, "assistant", "b"), (None, 1, "assistant", "c"), (101, 0, "assistant", "x" * 50_000)]
    check(spark, rows)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 8), st.integers(0, 20), st.sampled_from(ROLES), st.lists(st.sampled_from(["[", "INST]", "/", "\\", " ", "<s>", "</s>", "[NEXT]", "[TEXT]", "q"]), max_size=6).map("".join)), min_size=1, max_size=60, unique_by=lambda x: x[:2]))
def test_round_trip_of_random_turns(spark, rows):
    check(spark, rows)


def test_merge_and_mask(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "a"), (1, 2, "user", "b"), (1, 3, "assistant", "c"), (1, 4, "assistant", "[INST]")]
    r = format_chats(spark.createDataFrame(rows, SCHEMA.rsplit(",", 1)[0])).collect()[0]
    assert r["formatted"] == "[SYS] s [/SYS][INST] a [NEXT] b [/INST]<s> c [NEXT] \\[INST] </s>"
    assert [r["formatted"][s["start"] : s["end"]] for s in r["loss_spans"]] == ["c", "\\[INST]"]


def test_empty(spark):
    assert format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_thousands_of_turns(spark):
    """Time in proportion to the turns, of one role or of changing ones."""
    rows = [(1, i, "user", f"a{i}") for i in range(20_000)] + [(2, i, ROLES[i % 4], f"b{i}") for i in range(20_000)]
    check(spark, rows)


def test_long_turns(spark):
    """Reading 16,000 turns of 300 characters takes seconds, not minutes."""
    import time

    rows = [(1, i, ROLES[i % 2], f"{i} " + "é🙂x" * 100) for i in range(16_000)]
    df = format_chats(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).cache()
    df.count()
    start = time.time()
    got = read_chats(df).head()
    assert time.time() - start < 20
    assert got["loss_text"] == "".join(t for _, _, r, t in rows if r == "assistant") and len(got["turns"]) == 16_000
