import hashlib

from routeledger.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, n int, mark string, body string, formatted string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "m", "b", "f") for r in rows], SCHEMA)


def plain(rows):
    out = {}
    for c, t, r, x in rows:
        if c is not None:
            out.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    want = []
    for c, turns in out.items():
        turns.sort()
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        want.append((c, len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), sha(loss)))
    return sorted(want)


def test_everything_is_read_back(spark):
    rows = [(1, 2, "assistant", "</s>[INST] ok [/INST]"), (1, 1, "user", "<s>[+]\\0\\\\1"), (1, 3, "assistant", ""),
            (1, 4, "assistant", "\\"), (1, 5, "user", "]["), (1, 6, "assistant", "é😀</s>"),
            (2, 1, None, None), (2, 1, "assistant", "tie"), (2, 1, "assistant", "tie"), (2, None, "user", "first"),
            (3, 1, "[x]</s>", "odd role"), (3, 2, "+", "a"), (3, 3, "+", "b"), (None, 1, "user", "lost"),
            (4, 1, "assistant", "x" * 50_000), (5, 1, "user", "only")]
    got = sorted(tuple(r)[:5] for r in chat.digests(table(spark, rows)).collect())
    assert got == plain(rows)


def test_same_roles_merge_and_marks_stay_out_of_texts(spark):
    rows = [(1, 1, "user", "a [+]"), (1, 2, "user", "b"), (1, 3, "assistant", "c</s>"), (1, 4, "assistant", "d")]
    got = chat.formatted(table(spark, rows)).first()
    assert got.formatted == "<s>[user]a \\2+\\3[+]b</s>[assistant]c\\1/s>[+]d</s>"
    assert [got.formatted[m.start:m.start + m.length] for m in got.mask] == ["c\\1/s>", "d"]


def test_empty_table(spark):
    assert chat.digests(table(spark, [])).count() == 0
