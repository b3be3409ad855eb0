"""Nulls, empty and long texts, repeated rows, clashing extra columns, empty tables."""

import pytest

from colonnade.llm.jaccard_tiles import jaccard_components
from colonnade.llm.lm_brown import score_documents
from colonnade.llm.mixing_pareto import mix_pareto
from colonnade.llm.packing_ss import pack_documents
from colonnade.llm.pii_weak import detect_pii
from colonnade.llm.quality_mcd import mcd_outliers
from colonnade.llm.substring_windows import remove_repeats
from colonnade.llm.topk_columnar import exact_topk
from colonnade.llm.url_rules import judge_urls

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, k string, t string, n string, a string, comp int, "
          "row_key string, bucket string, size string, target string, start string, _l string, held boolean, spans string, id string")


def row(i, text, source="s"):
    return (i, text, None if i == 2 else "en", source, None, "x", "y", "z", "w", 1, "r", "b", "q", "g", "h", "l", False, "p", "u")


ROWS = [row(1, "one two three four five six seven"), row(1, "one two three four five six seven"), row(2, None, None), row(3, ""),
        row(4, "w" * 200_000 + " 1" * 50_000 + "@"), row(5, " \n\t ")]
RUNS = {
    "quality": lambda d: mcd_outliers(d), "pack": lambda d: pack_documents(d), "pii": lambda d: detect_pii(d), "mix": lambda d: mix_pareto(d),
    "repeats": lambda d: remove_repeats(d), "jaccard": lambda d: jaccard_components(d), "lm": lambda d: score_documents(d, held_out="held"),
}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_edges(spark, name):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = RUNS[name](docs).collect()
    assert {r["doc_id"] for r in got} == {1, 2, 3, 4, 5} and (name == "pack" or len(got) == len(ROWS))
    assert RUNS[name](docs.limit(0)).collect() == []


def test_urls_and_vectors(spark):
    urls = [(1, None), (2, "no scheme"), (2, "no scheme"), (3, "http://A.NET"), (4, "http://a.net/x")]
    got = sorted(tuple(r)[:4] for r in judge_urls(spark.createDataFrame(urls, "page_id long, url string")).collect())
    assert got == [(1, "", "", None), (2, "", "", None), (2, "", "", None), (3, "a.net", "", None), (4, "a.net", "/x", "net/")]
    v = spark.createDataFrame([(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [1.0, 0.0]), (5, [1.0, 0.0])],
                              "vec_id long, embedding array<double>")
    assert [tuple(r) for r in exact_topk(v, v.where("vec_id = 0")).orderBy("rank").collect()] == [(0, 1, 4, 65536), (0, 2, 5, 65536)]
    assert exact_topk(v.limit(0), v.limit(0)).count() == 0


def test_large_ids_next_to_null_ids(spark):
    big = 2**53 + 1
    text = "one two three four five six seven mail a.b@c.de"
    docs = spark.createDataFrame([(big, text), (None, text + " x"), (None, None), (big + 2, "")], "doc_id long, text string").repartition(1)
    want = {"9007199254740993", "9007199254740995", "None"}
    for name, out in (("pack", pack_documents(docs)), ("pii", detect_pii(docs, keep=("text",))), ("repeats", remove_repeats(docs)), ("jaccard", jaccard_components(docs))):
        rows = out.collect()
        assert {str(r["doc_id"]) for r in rows} == want, name
        if name == "jaccard":
            assert {str(r["doc_id"]): str(r["component_id"]) for r in rows}[str(big)] == str(big)


def _words(r, size):
    return [f"w{r.randint(0, 10**6)}" for _ in range(size)]


def test_jaccard_null_and_repeated_ids(spark):
    """A chain through a row without id, and one id on two texts, keep all links."""
    import random
    r = random.Random(1)
    base = _words(r, 100)
    texts = [" ".join(base), " ".join(base[4:] + _words(r, 4)), " ".join(base[8:] + _words(r, 8))]
    other = _words(r, 60)
    rows = [(1, texts[0]), (None, texts[1]), (3, texts[2]), (7, "and quite another text with seven words"), (7, " ".join(other)), (9, " ".join(other[2:]))]
    for part in (rows, rows[::-1]):
        got = jaccard_components(spark.createDataFrame([(*x, "e", 1) for x in part], "doc_id long, text string, comp string, n int")).collect()
        assert sorted((str(x["doc_id"]), x["n_shingles"], x["component_id"]) for x in got) == sorted(
            [("1", 96, 1), ("None", 96, 1), ("3", 96, 1), ("7", 3, 7), ("7", 56, 7), ("9", 54, 7)])


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_equals_brute_force_on_chains_and_crowded_shingles(spark, seed, monkeypatch):
    """Sizes at the borders of bands, near copies of near copies, a passage in half of the texts, repeated words."""
    import importlib.util
    import os
    import random
    spec = importlib.util.spec_from_file_location("llm_brute8", os.path.join(os.path.dirname(__file__), "brute.py"))
    brute = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(brute)
    from colonnade.llm import jaccard_tiles
    if seed == 2:
        monkeypatch.setattr(jaccard_tiles, "SAMPLE_SETS", 30)
        monkeypatch.setattr(jaccard_tiles, "FREQUENT", 20)
        monkeypatch.setattr(jaccard_tiles, "GROUP", 2)
        monkeypatch.setattr(jaccard_tiles, "BLOCK", 2)
        monkeypatch.setattr(jaccard_tiles, "BITS", 64)
    r = random.Random(seed)
    passage = _words(r, 40)
    texts = []
    for _ in range(40):
        base = _words(r, r.choice([1, 3, 5, 6, 12, 30, 60])) + (passage if r.random() < 0.5 else [])
        texts.append(base)
        for _ in range(r.randint(0, 4)):
            t = list(texts[-1])
            for _ in range(r.randint(0, 4)):
                i = r.randrange(len(t) + 1)
                t[i:i + r.randint(0, 1)] = _words(r, r.randint(0, 1))
            texts.append(t)
    texts += [["a"] * k for k in (4, 5, 6, 30)] + [[], ["A", "b"], ["a", "B"]]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    r.shuffle(docs)
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == dict(zip([d for d, _ in docs], brute.op8([d for d, _ in docs], [t for _, t in docs])))


def test_signature_bounds_hold():
    """The bound is never below the true overlap, whatever the lengths of the signatures."""
    import numpy as np

    from colonnade.llm.jaccard_tiles import bounded_pairs, fold, signature
    r = np.random.default_rng(0)
    for _ in range(200):
        common = r.integers(0, 2**63, r.integers(1, 400)).astype(np.uint64)
        sets = [np.unique(np.concatenate([common, r.integers(0, 2**63, r.integers(0, 120)).astype(np.uint64)])) for _ in range(6)]
        sigs = [signature(s) for s in sets]
        got = {(i, int(j)) for i, js in bounded_pairs(np.array([len(s) for s in sets]), np.arange(6), sigs, 80) for j in js}
        for i in range(6):
            assert len(fold(sigs[i], 8)) == 8
            for j in range(i + 1, 6):
                k = len(np.intersect1d(sets[i], sets[j]))
                if 100 * k >= 80 * (len(sets[i]) + len(sets[j]) - k):
                    assert (i, j) in got


@pytest.mark.parametrize("chunk", [1, 60, 10**6])
def test_repeats_of_a_hot_window(spark, chunk):
    """One passage in a third of all rows, copies with and without ids, a text that repeats itself: any chunk size gives
    what brute force gives, and a bucket sees a hash at most once a chunk."""
    import random

    from colonnade.llm import windows
    from colonnade.llm.substring_windows import WordHashes, apart, byte_words, rolling
    from tests.llm import brute
    from pyspark.sql import functions as F

    r = random.Random(3)
    hot = _words(r, 12)
    texts = [" ".join(_words(r, 9) + (hot if i % 3 == 0 else _words(r, 4)) + _words(r, 6)) for i in range(60)]
    texts += [texts[1]] * 20 + [" ".join(_words(r, 7) * 3), " ".join(["x"] * 40), None, "", "few words"]
    ids = [None if i % 7 == 0 else i for i in range(len(texts))]
    docs = spark.createDataFrame(list(zip(range(len(texts)), ids, texts)), "n int, doc_id long, text string").repartition(3)
    want = brute.op6(texts, 7)
    rows = docs.select("n", F.col("text").alias("t"), F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64("text").alias("k2"))
    h = WordHashes()
    spans = windows.repeated_spans(rows, "t", lambda t: rolling(h(byte_words(t)), 7) if len(byte_words(t)) >= 7 else h([]), 5, 7, chunk)
    got = {x["n"]: apart(x["spans"]) for x in rows.join(spans, ["k1", "k2"], "left").collect()}
    assert len(got) == len(texts)
    assert [sum(e - s for s, e in got[i]) for i in range(len(texts))] == [gone for _, gone, _ in want]
    out = remove_repeats(docs, window=7)
    assert sorted((x["n_words"], x["n_removed"], x["kept_sha256"]) for x in out.collect()) == sorted(want)


def test_mix_against_brute_force(spark):
    """Inclusion by water-filling, ranks by odds and passed-over documents equal a plain Python version; gaps are small;
    null ids do not share a rank."""
    import math
    import random

    from pyspark.sql import functions as F

    r = random.Random(5)
    rows = []
    for i in range(900):
        n = r.choice([0, 3, 8, 20, 60]) if i % 50 else r.randint(300, 900)
        rows.append((None if i % 9 == 0 else i, " ".join(_words(r, n)), r.choice("aaaabbc")))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    weight = F.size(F.split("text", " ")).cast("double")  # steep: long documents become certain copies
    got = mix_pareto(docs.withColumn("key", F.struct("doc_id", "text", "source")), key="key", priority=weight).collect()
    u = {(x["doc_id"], x["text"]): x["u"] for x in docs.select("doc_id", "text", ((F.pmod(F.xxhash64(F.struct("doc_id", "text", "source"), F.lit(17), "text"), F.lit(1 << 52)) + 0.5) / float(1 << 52)).alias("u")).collect()}
    assert sum(x["inclusion"] == 1 for x in got) > 0
    for s in "abc":
        mine = [x for x in got if x["key"]["source"] == s]
        target, whole = mine[0]["target"], int(mine[0]["target"] // mine[0]["source_size"])
        left = target - whole * mine[0]["source_size"]
        w = {id(x): 2 ** (round(math.log2(max(1, len(x["key"]["text"].split(" ")))) * 256) / 256) for x in mine}
        free, factor = list(mine), 0.0
        while left > 0:
            have = left - sum(x["size"] for x in mine if all(x is not y for y in free))
            factor = have / sum(x["size"] * w[id(x)] for x in free)
            still = [x for x in free if factor * w[id(x)] < 1]
            if len(still) == len(free):
                break
            free = still
        sure = {id(x) for x in mine} - {id(x) for x in free}
        for x in mine:
            assert abs(x["inclusion"] - (1 if id(x) in sure else factor * w[id(x)])) < 1e-9

        def odds(x):
            p, v = x["inclusion"], u[(x["key"]["doc_id"], x["key"]["text"])]
            return v / (1 - v) * (1 - p) / p if p else 1e300
        taken, gap = set(sure), left - sum(x["size"] for x in mine if id(x) in sure)
        rest, tol, bound, most, last = sorted(free, key=odds), target * 0.001, 0.0, 1e18, False
        while gap > bound:
            fit = [x for x in rest if x["size"] and x["size"] <= most]
            if not fit and not last:
                most, last, bound = 2 * gap, True, tol
                continue
            cum = 0
            for x in fit:
                if cum >= gap or cum + x["size"] - gap > (gap - cum if last else tol):
                    break
                cum += x["size"]
                taken.add(id(x))
            rest = [x for x in rest if id(x) not in taken]
            gap, bound = gap - cum, tol
            most = gap + tol
            if last:
                break
        assert {id(x) for x in mine if x["copies"] > whole and x["size"]} == {i for i in taken if next(x for x in mine if id(x) == i)["size"]}
        assert abs(sum(x["taken"] for x in mine) - target) <= max(3, 0.001 * target)
    from collections import Counter
    nulls = Counter(x["copies"] for x in got if x["key"]["doc_id"] is None and x["key"]["source"] == "a" and 0 < x["inclusion"] < 1)
    assert len(nulls) > 1


def test_settled_tiles_and_told_pairs(spark, monkeypatch):
    """Tiles of two sets are settled by their hub and are not compared again; a task passes its pairs on in bounded batches."""
    from colonnade.llm import jaccard_tiles

    seen, whole = [], jaccard_tiles._open_pairs

    def spy(left, classes, percent):
        seen.extend(r.m for r in left.select("m").collect())
        return whole(left, classes, percent)

    monkeypatch.setattr(jaccard_tiles, "_open_pairs", spy)
    monkeypatch.setattr(jaccard_tiles, "TOLD", 3, raising=False)
    tail = " ".join(f"t{j}" for j in range(3))
    twos = [(10 * i + k, " ".join(f"a{i}_{j}" for j in range(12)) + f" {tail} " + " ".join(f"b{i}_{k}_{j}" for j in range(8))) for i in range(6) for k in range(2)]
    many = [(1_000 + k, " ".join(f"c{j}" for j in range(40)) + " " + " ".join(f"d{k}_{j}" for j in range(8))) for k in range(20)]
    linked = [(2_000 + k, " ".join(f"e{j}" for j in range(200)) + f" f{k}") for k in range(2)]
    docs = twos + many + linked
    got = {r.doc_id: r.component_id for r in jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert min(seen) > 2

    def shingles(text):
        w = text.split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

    sets = {i: shingles(t) for i, t in docs}
    comp = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            comp[i] = min(comp[j] for j in sets if i == j or 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]))
    assert got == comp
