import collections
import math
import random
import types
import zlib

import numpy as np

from routeledger.llm import language_model as M, shared

from .conftest import FOLD, WORD


def plain(rows):
    """held_out, n_tokens, n_known, train_tokens and base_score of each row."""
    tokens = [(i, WORD.findall((t or "").translate(FOLD)) + ["\n"]) for i, t in rows]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    c = collections.Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    return sorted((i, held(i), len(ws), sum(c[w] > 0 for w in ws), n,
                   round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in tokens)


def result(df):
    return sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect())


def test_base_scores_and_held_out_perplexity(spark):
    table = shared.read(spark, "/root/testdata/sf0.01", "documents")
    out = M.scored(table).cache()
    assert result(out) == plain([(r.doc_id, r.text) for r in table.collect()])
    score, base, spelled = out.where("held_out").selectExpr("sum(score)", "sum(base_score)", "sum(spelled_score)").first()
    assert score > base and spelled < score


def test_probabilities_sum_to_one(spark):
    words = [(f"{a}{b}", (i * 7 + j) % 5) for i, a in enumerate(["ka", "lo", "mi", "x"]) for j, b in enumerate(["", "na", "to"])]
    words += [("", 9), ("often", 4000)]
    table = shared.landed(spark.createDataFrame(words, "word string, n long"), "words")
    got = M.word_probabilities(table, sum(n for _, n in words)).collect()
    known = sum(10**r.logp for r in got if r.n)
    unknown = {round(10**r.logp, 12) for r in got if not r.n}
    assert len(unknown) == 1 and abs(known + unknown.pop() - 1) < 1e-9
    assert all(r.spelled <= r.logp + 1e-12 for r in got)


def test_table_draws_follow_their_distribution():
    """Mean tables of 3 customers at pull a: weights (1-d)(2-d), 3 (1-d) a, a^2 for 1, 2 and 3 tables."""
    d, a, n = 0.5, 0.7, 40_000
    draws = M.tables(np.full(n, 3), np.full(n, a), d, M.W.mix(np.arange(n, dtype=np.uint64)), 1)
    w = np.array([(1 - d) * (2 - d), 3 * (1 - d) * a, a * a])
    assert np.allclose(np.bincount(draws, minlength=4)[1:] / n, w / w.sum(), atol=0.01)
    many = M.tables(np.full(500, 100_000), np.full(500, 5.0), d, M.W.mix(np.arange(500, dtype=np.uint64)), 1)
    assert 20 < many.mean() < 200 and (M.tables(np.zeros(3, int), np.ones(3), d, np.zeros(3, np.uint64), 1) == 0).all()


def test_letters_sum_to_one():
    code, first = M._codes(M.pa.array(["aba", "b", "", "abc"]))
    letters = M._spelling(*np.unique(code, return_counts=True), 1)
    context = code[2] // M._LETTERS
    total = np.exp(letters.log(context * M._LETTERS + np.arange(M._LETTERS))).sum()
    assert abs(total - 1) < 1e-9 and first.tolist() == [0, 4, 6, 7, 11]


def test_odd_rows(odd, docs):
    rows = [(r.doc_id, r.text) for r in odd.collect() if r.doc_id is not None]
    assert result(M.scored(odd)) == plain(rows)
    assert M.scored(docs([])).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    got = M.scored(docs([(held, "a b")])).first()
    assert (got.train_tokens, got.n_known, got.n_tokens) == (0, 0, 3) and got.score <= 0


def test_score_follows_the_order_of_words(docs):
    """Pairs that training texts hold are likelier than the same words the other way round."""
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 7 == 2]
    taught = [(i, f"red car blue sky {i % 9}") for i in range(400) if i not in held]
    got = {r.doc_id: r for r in M.scored(docs([*taught, (held[0], "red car blue sky"), (held[1], "sky car blue red")])).collect()}
    one, two = got[held[0]], got[held[1]]
    assert one.base_score == two.base_score and one.score > two.score + 3 and one.spelled_score > two.spelled_score + 3


def test_followers_of_a_word_sum_to_one():
    """All words and an unknown one after the start of a text, from given counts of pairs and their tables."""
    words, d, logp = ["", "a", "b", "zz"], 0.6, np.log10([0.4, 0.3, 0.2, 0.1])
    split = M.W.split(M.pa.array(words[1:]), M.W.SPACE, False)
    order = np.argsort(split.hash)
    texts = M.W.split(M.pa.array(words), M.W.SPACE, False)
    token = np.zeros(7, np.uint64)
    token[[1, 3, 5]] = texts.hash
    parts = [(np.arange(4), np.ones(4, bool), np.array([1, 2, 2, 2]), token, split.hash[order], M._strings(split, order))]
    group = M.pa.Table.from_batches([M._group(parts, 0)])
    g = M._opened(next(M._each(group.to_batches())))
    place = [0, *(1 + np.argsort(order))]  # of words in the group
    n, seats, p = np.zeros(4, int), np.zeros(4, int), np.zeros(4)
    n[place], seats[place], p[place] = [9, 4, 3, 0], [6, 2, 3, 0], logp
    c, t = np.zeros(len(g.pair), int), np.zeros(len(g.pair), int)
    for w, x, y in zip(place, (2, 4, 3, 0), (1, 3, 2, 0)):
        k = (g.before == 0) & (g.word == w)
        c[k], t[k] = x, y
    back = M.pa.Table.from_batches([M._rows(M._ANSWER, [
        (0, -1, M._pack(c), M._pack(t)), (0, 0, M._pack(n), M._pack(seats), p.tobytes(), -1.0)])])
    got = 10 ** M._score_rows(25, 3, d)(group, back).column("score").to_numpy()
    end = [1, *((M.PAIR_STRENGTH + d * s) * 0.4 / (M.PAIR_STRENGTH + k) for k, s in ((4, 2), (3, 3), (0, 0)))]
    assert abs((got / end).sum() - 1) < 1e-9


def test_draws_do_not_depend_on_company():
    key = M.W.mix(np.arange(300, dtype=np.uint64))
    n, pull = np.arange(300) * 40, np.linspace(0.1, 90, 300)
    whole = M.tables(n, pull, 0.6, key, 1)
    assert all(M.tables(n[i:i + 1], pull[i:i + 1], 0.6, key[i:i + 1], 1)[0] == whole[i] for i in range(0, 300, 7))
    mean = np.repeat([0.5, 20.0, 400.0], 20_000)
    draws = M._poisson(mean, M.W.mix(np.arange(60_000, dtype=np.uint64)), 1).reshape(3, -1)
    assert np.allclose(draws.mean(axis=1), [0.5, 20, 400], rtol=0.02) and np.allclose(draws.var(axis=1), [0.5, 20, 400], rtol=0.05)


def test_counts_keep_any_width():
    for x in ([], [0], [255, 256], [1 << 40, 3]):
        assert M._longs(M._pack(np.array(x, np.int64))).tolist() == x


def plain_scores(rows):
    """score and spelled_score of each row, and how often a repeated pair's tables changed: all pairs in one table, redrawn in every sweep."""
    texts = [(i, WORD.findall((t or "").translate(FOLD)) + [""]) for i, t in rows]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    both = lambda ws: list(zip(["", *ws[:-1]], ws))
    names = sorted({w for _, ws in texts for w in ws})
    at = {w: i for i, w in enumerate(names)}
    hashes = np.concatenate([np.zeros(1, np.uint64), M.W.split(M.pa.array([" ".join(names[1:])]), M.W.SPACE, False).hash])
    counted = collections.Counter(p for i, ws in texts if not held(i) for p in both(ws))
    u, w, c = (np.array(x) for x in zip(*((at[a], at[b], n) for (a, b), n in counted.items())))
    count = np.bincount(w, c, len(names)).astype(int)
    key = M._keys(M.W.mix(M.W.mix(hashes[u] + np.uint64(0x9E3779B97F4A7C15)) + hashes[w]))
    d, strength = M._discount((c == 1).sum(), (c == 2).sum()), M.PAIR_STRENGTH
    seats, share, t, changed, below, now, kept = M._average_tables(count, d), count / count.sum(), None, 0, None, None, []
    for sweep in range(1, M.SWEEPS + 1):
        new = M.tables(c, (strength + d * seats[u]) * share[w], d, key, sweep - 1)
        changed, t = changed + (0 if t is None else int((new != t).sum())), new
        n, seats = (np.bincount(x, t, len(names)).astype(int) for x in (w, u))
        batch = M.pa.RecordBatch.from_arrays([M.pa.array(names), M.pa.array(n)], ["word", "n"])
        below = below or M._discount((n == 1).sum(), (n == 2).sum())

        def state(start, number):
            got = dict(zip(*(x.to_numpy() for x in next(M._sweep_rows(start, below, number)(iter([batch]))).columns)))
            tables, known = got.pop(-1), got.pop(-2)
            return M.Sweep(tables, known, M._spelling(np.array(list(got)), np.array(list(got.values())), number))

        now = now or state(None, 0)
        after = state(types.SimpleNamespace(value=now), sweep)
        _, logp, spelled = next(M._probabilities(iter([batch]), [(now, after, sweep)], below, n.sum()))
        share = 10 ** spelled.astype("<f4").astype(float)
        unknown = 10 ** logp[n == 0][0] if (n == 0).any() else 0.0
        kept, now = [*kept, (dict(zip(counted, t)), seats, share, unknown)], after
    def log(pair, spell):
        a, b = at[pair[0]], at[pair[1]]
        return math.log10(sum(
            (max(counted[pair] - d * t.get(pair, 0), 0) + (strength + d * s[a]) * (p[b] if spell or count[b] else u))
            / (strength + count[a]) for t, s, p, u in kept[-M.KEPT:]) / M.KEPT)
    return sorted((i, *(sum(log(p, spell) for p in both(ws)) for spell in (False, True))) for i, ws in texts), changed


def test_scores_are_those_of_pairs_redrawn_in_every_sweep(docs):
    rnd = random.Random(3)
    rows = [(i, " ".join(f"w{int(rnd.paretovariate(0.8)) % 97}" for _ in range(rnd.randrange(60)))) for i in range(150)]
    rows.append((next(i for i in range(200, 400) if zlib.crc32(str(i).encode()) % 7 == 2), "w1 never w2 seen"))
    want, changed = plain_scores(rows)
    assert changed > 50
    for parts in (1, 4):
        got = sorted((r.doc_id, r.score, r.spelled_score) for r in M.scored(docs(rows).repartition(parts)).collect())
        assert [g[0] for g in got] == [w[0] for w in want]
        assert np.allclose([g[1:] for g in got], [w[1:] for w in want], rtol=1e-6, atol=1e-6)
