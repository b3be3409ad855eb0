"""Operators 11 to 13 against brute force, the tokenizers library and numpy's eigenvalues."""

import hashlib
import random
import re
import zlib
from array import array

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from colonnade.llm import period_tiles as tiles
from colonnade.llm.bpe_stream import _AGREED, Bpe, Merges, WordTransducer, encode_documents
from colonnade.llm.queries import with_planted_periods
from colonnade.llm.whitening import count_above, leading_eigenpairs, whiten

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCAB = public_tokenizers.path("word_bpe_49k.json")


def brute_runs(w):
    best = {}
    for p in range(1, len(w) // 4 + 1):
        i = 0
        while i + p < len(w):
            if w[i] != w[i + p]:
                i += 1
                continue
            a = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            if i - a + p >= max(6, 4 * p):
                best.setdefault((a, i - a + p), p)
    return sorted((a, p, n) for (a, n), p in best.items())


def planted(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def want11(doc_id, text):
    w = planted(doc_id, text)
    runs = brute_runs(w)
    gone = {i for a, p, n in runs for i in range(a + p, a + n)}
    said = "".join(f"{a},{n},{p}\n" for a, p, n in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    best = min(((-n, a, p) for a, p, n in runs), default=None)
    top = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    return (len(runs), *top, hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_op11_whole_table(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = {r["doc_id"]: tuple(r[c] for c in ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"))
           for r in entry.queries()["op11_periodic_runs"](spark, SF).collect()}
    assert got == {d: want11(d, t) for d, t in docs}
    assert sum(v[0] > 0 for v in got.values()) > 5


def random_words(r, size):
    out = []
    while len(out) < size:
        if r.random() < 0.5:
            unit = [r.randint(0, 2) for _ in range(r.randint(1, r.choice([3, 9, 30])))]
            out += (unit * 8)[:r.randint(1, 7 * len(unit))]
        else:
            out += [r.randint(0, r.choice([1, 3, 50])) for _ in range(r.randint(1, 20))]
    return out


def test_tiles_find_all_runs():
    """Any tile width gives the runs of the whole document, also several documents in one array."""
    r = random.Random(3)
    docs = [random_words(r, r.randint(0, 300)) for _ in range(150)] + [[0] * 300, [0, 1] * 200, [], [1], [0] * 6, [0] * 5, [0, 1] * 4, [0, 1] * 3]
    for i in range(0, len(docs), 17):
        part = docs[i:i + 17]
        got = tiles._runs_of([np.array(x, np.int64) for x in part])
        assert [[(x["start"], x["period"], x["length"]) for x in g] for g in got] == [brute_runs(d) for d in part]


def test_stitched_tiles(spark):
    """Long documents by the shuffled path: tiles of 16 words, copies, nulls, clashing column names, an empty table."""
    r = random.Random(5)
    docs = [(i, " ".join(map(str, random_words(r, 200)))) for i in range(40)]
    docs += [(50, "a " * 3000), (51, " ".join(map(str, range(700))) + " " + "x y z " * 100), (51, docs[0][1]), (None, docs[0][1]),
             (2**53 + 1, None), (53, ""), (54, " \n\t "), (55, "w" * 100_000)]
    df = spark.createDataFrame([(*d, "k", 1, "b") for d in docs], "doc_id long, text string, key string, start int, body string")
    got = tiles.periodic_runs(df, keep=("doc_id", "key"), tile=16)
    rows = sorted((str(x["doc_id"]), x["n_words"], [(q["start"], q["period"], q["length"]) for q in x["runs"]]) for x in got.collect())
    assert rows == sorted((str(d), len(WORD.findall(t or "")), brute_runs(WORD.findall(t or ""))) for d, t in docs)
    assert tiles.periodic_runs(df.limit(0)).collect() == []
    one = {x["doc_id"]: x["collapsed"] for x in tiles.periodic_runs(df, tile=16).where("doc_id in (50, 53)").collect()}
    assert one == {50: "a", 53: ""}


def test_hash_collisions_are_cut():
    words = np.array([1, 2, 1, 2, 9, 2, 1, 2, 1, 2], np.int64)
    assert tiles._checked(words, np.array([[2, 0, 8]])).tolist() == [[2, 0, 2], [2, 3, 4], [2, 5, 8]]


def test_planted_periods(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i % 60))) for i in range(300)] + [(None, "a b"), (10**6, None)], "doc_id long, text string")
    for r in with_planted_periods(docs).collect():
        source = " ".join(f"w{j}" for j in range(r[0] % 60)) if r[0] is not None and r[0] < 300 else "a b" if r[0] is None else None
        assert WORD.findall(r[1] or "") == (planted(r[0], source) if r[0] is not None else ["a", "b"])


@pytest.fixture(scope="module")
def bpe():
    return Bpe(VOCAB)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCAB)


def test_op12_whole_table(spark, library):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    want = {}
    for d, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        said = library.decode(ids, skip_special_tokens=False)
        want[d] = (len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256(said.encode()).hexdigest())
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in entry.queries()["op12_bpe_stream"](spark, SF).collect()}
    assert got == want


ALPHABET = ["a", "b", "w", "s", "'", "'s", "'re", "l", "ll", " ", "\n", "!", "?", "1", "23", "é", "é", "́", "Σ", "İ", "ß", "<|endoftext|>",
            "<|startoftext|>", "<|", "<", "中", "한", "ᄀ", "ᅡ", "👍", "😂", "क़", "ে", "া", "½", "٣", "\x85", "　", "\x1c", "_", "the", "ing", "</w>",
            "‍", "ſ", "Å", "ﬁ"]


@pytest.mark.parametrize("chunk", [1, 2, 5, 1000])
def test_any_chunks_give_the_same_ids(bpe, library, chunk):
    r = random.Random(chunk)
    for _ in range(1500):
        t = "".join(r.choice(ALPHABET) for _ in range(r.randint(0, 30)))
        ids = library.encode(t, add_special_tokens=False).ids
        got = b"".join(bpe.encode(t[i:i + chunk] for i in range(0, len(t), chunk)))
        assert array("I", got).tolist() == ids, t
        said = "".join(bpe.decode(got[i:i + 4 * chunk] for i in range(0, len(got), 4 * chunk)))
        assert said == library.decode(ids, skip_special_tokens=False)


def test_words_without_end_stay_in_a_bounded_buffer(bpe, library):
    r = random.Random(0)
    ahead = bpe.merges.lookahead()
    long = ["w" * 4000, "ab" * 3000, "".join(r.choice("aehinst") for _ in range(6000)), "!" * 5000, "😂" * 2000, "a'" * 999,
            "".join(r.choice("!?.-=") for _ in range(5000)), "o" * 70 + "k"]
    for t in long:
        got = array("I", b"".join(bpe.encode(t[i:i + 100] for i in range(0, len(t), 100)))).tolist()
        assert got == library.encode(t, add_special_tokens=False).ids
        assert bpe.word.unsettled <= ahead < 1000


def test_characters_below_the_agreed_bound(bpe, library):
    for c in range(ord(_AGREED)):
        s = "a" + chr(c) + "b"
        assert bpe.normalise(s).split() == library.normalizer.normalize_str(s).split() or chr(c).isspace()
        assert array("I", bpe.encode_text(s)).tolist() == library.encode(s, add_special_tokens=False).ids


def naive(merges, symbols):
    rank = {tuple(m): i for i, m in enumerate(merges)}
    s = list(symbols)
    while True:
        found = min(((rank[p], i) for i, p in enumerate(zip(s, s[1:])) if p in rank), default=None)
        if found is None:
            return s
        s[found[1]:found[1] + 2] = [s[found[1]] + s[found[1] + 1]]


def test_random_merge_lists():
    """The transducer equals merging by rank, leftmost first, for small merge lists; lookahead bounds what stays."""
    r = random.Random(7)
    for _ in range(60):
        merges, known = [], ["a", "b", "c", "a</w>", "b</w>", "c</w>"]
        while len(merges) < 14:
            x, y = r.choice([k for k in known if not k.endswith("</w>")]), r.choice(known)
            if x + y not in known:
                merges.append([x, y])
                known.append(x + y)
        m = Merges({t: i for i, t in enumerate(known)}, merges)
        t = WordTransducer(m)
        t.STEP = 4
        for _ in range(40):
            w = "".join(r.choice("aabbc") for _ in range(r.randint(1, 60)))
            t.reset()
            got = [i for k in range(0, len(w) - 1, 7) for i in t.feed(w[:-1][k:k + 7])] + t.finish(w[-1])
            assert [known[i] for i in got] == naive(merges, [*w[:-1], w[-1] + "</w>"])
        assert t.unsettled <= m.lookahead()


def test_plain_decoding_and_edges(spark, bpe):
    assert "".join(bpe.decode([bpe.encode_text("Hello wörld 😂!")[i:i + 4] for i in range(0, 400, 4)], plain=True)) == "hello wörld 😂! "
    rows = [(1, "a b"), (1, "a b"), (None, "c"), (2**53 + 1, None), (4, ""), (5, "w" * 200_000), (6, "é" * 70_000 + "́" * 1000)]
    df = spark.createDataFrame([(*x, "i", 7) for x in rows], "doc_id long, text string, ids string, n_tokens int")
    got = encode_documents(df, VOCAB, batch_bytes=1000).collect()
    assert [r["doc_id"] for r in got] == [x[0] for x in rows] and [r["n_tokens"] for r in got][3:5] == [0, 0]
    assert encode_documents(df.limit(0), VOCAB).collect() == []


def test_inertia_and_eigenpairs():
    r = np.random.default_rng(0)
    for n in (1, 2, 3, 5, 16, 48):
        for t in range(12):
            a = r.standard_normal((n, n)) * r.choice([1, 1e-3, 100], n)
            m = a @ a.T
            if t % 4 == 1:
                m = np.eye(n) * 3
            elif t % 4 == 2 and n > 2:
                q = np.linalg.qr(a)[0]
                m = (q * np.array([5, 5, 5] + [1] * (n - 3))) @ q.T
                m = (m + m.T) / 2
            elif t % 4 == 3:
                m = np.outer(a[0], a[0])
            w = np.linalg.eigvalsh(m)
            for s in r.uniform(w.min() - 1, w.max() + 1, 4):
                assert count_above(m, s) == (w > s).sum()
            e, v, proof = leading_eigenpairs(m, 4)
            assert np.allclose(e, w[::-1][:4], rtol=1e-12, atol=1e-12 * max(1, abs(w).max()))
            assert np.abs(v.T @ v - np.eye(v.shape[1])).max() < 1e-10 and np.abs(m @ v - v * e).max() < 1e-9 * max(1, abs(w).max())
            assert all(over <= j < under for j, (over, under) in enumerate(proof))


def test_op13_whole_table(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    x = np.floor(256 * np.array([v for _, v in rows])).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    cov = (fit - s / n).T @ (fit - s / n) / n
    w, u = np.linalg.eigh(cov)
    w, u = w[::-1][:4], u[:, ::-1][:, :4]
    white = (x - s / n) @ u / np.sqrt(w)
    got = entry.queries()["op13_whitening"](spark, SF).toPandas().set_index(["vec_id", "component"])
    assert len(got) == 4 * len(rows) and (got.n == n).all() and got.identity_error.max() < 1e-12
    ids = [d for d, _ in rows]
    g = np.stack([got.xs(c, level=1).whitened.loc[ids] for c in (1, 2, 3, 4)], axis=1)
    g *= np.sign(g[0] * white[0])
    assert np.abs(g - white).max() < 1e-9
    assert (got.xs(1, level=1).deviation.loc[ids].to_numpy() == ((n * x - s) ** 2).sum(axis=1)).all()
    assert np.allclose([got.xs(c, level=1).explained.iloc[0] for c in (1, 2, 3, 4)], w / np.trace(cov), rtol=1e-9)


def test_whitening_edges(spark):
    rows = [(1, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (2, None), (3, [None, 1.0, 1.0]), (4, [float("nan"), 1.0, 1.0]), (5, [1e300, 1.0, 2.0]), (6, []),
            (7, [2.0, 1.0, 0.5]), (None, [0.0, 0.0, 1.0]), (8, [1.0]), (2**53 + 1, [4.0, 2.0]), (11, [4.0, 2.0]), (12, [float("inf"), 0.0, 0.0])]
    df = spark.createDataFrame([(*r, "c", 1.0) for r in rows], "vec_id long, embedding array<double>, x string, component double")
    got = whiten(df).orderBy("component").collect()
    assert sorted((str(r["vec_id"]) for r in got)) == sorted(["1"] * 6 + ["7"] * 3 + ["None"] * 3 + ["8"] + [str(2**53 + 1)] * 2 + ["11"] * 2)
    three = [r for r in got if r["vec_id"] == 1]
    x = np.array([[256, 512, 768], [512, 256, 128], [0, 0, 256]])
    assert {r["n"] for r in three} == {3} and {r["deviation"] for r in three} == {int(((3 * x[0] - x.sum(axis=0)) ** 2).sum())}
    # Three vectors span two directions; the third has no variance.
    assert [(r["whitened"] is None, r["explained"] == 0) for r in three if r["component"] == 3] == [(True, True)] * 2
    assert all(r["whitened"] is None and r["explained"] is None and r["n"] == 1 for r in got if r["vec_id"] in (8, 11))
    assert whiten(df.limit(0)).collect() == []
    wide = spark.createDataFrame([(1, [1e16, 1.0]), (2, [-1e16, 1.0]), (3, [0.0, 2.0])], "vec_id long, embedding array<double>")
    assert {r["deviation"] for r in whiten(wide).collect() if r["vec_id"] != 3} == {None}
