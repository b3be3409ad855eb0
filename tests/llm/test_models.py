"""Models: base counts against brute force, gain over the unigram on held-out texts, licence families."""

import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np

import __spark_entry__ as entry
from colonnade.llm.licences import scan_licences
from colonnade.llm.lm_brown import exchange, score_documents
from colonnade.llm.pii_weak import detect_pii, extra_candidates
from colonnade.llm.quality_mcd import mcd_outliers

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_brown(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    low = lambda t: re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    toks = {d: [*WORD.findall(low(t)), None] for d, t in docs}
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in toks}
    c = Counter(w for d, ws in toks.items() if not held[d] for w in ws)
    n, v = sum(c.values()), len(c)
    rows = entry.queries()["op3_lm_brown"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ws = toks[r["doc_id"]]
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(ws), sum(c[w] > 0 for w in ws), n)
        assert abs(r["base_score"] - base) < 1e-6 * max(1, abs(base)) and r["score"] < 0
    assert sum(r["score"] for r in rows if r["held_out"]) > sum(r["base_score"] for r in rows if r["held_out"])


def test_brown_leaves_no_tables_of_past_sweeps(spark):
    import glob

    from colonnade.session import checkpoint_root, local_path

    def left() -> set[str]:
        return set(glob.glob(f"{local_path(checkpoint_root(spark))}/scratch/lm-*"))

    docs = spark.createDataFrame([(i, " ".join(f"w{(i * j) % 17}" for j in range(40)), i % 7 == 0) for i in range(60)], "doc_id long, text string, held boolean")
    before = left()
    assert score_documents(docs, held_out="held", classes=4).count() == 60
    kinds = sorted(p.rsplit("/", 1)[1].split("-")[1].rstrip("0123456789") for p in left() - before)
    assert kinds == ["classes", "rows"]


def test_brown_sweeps_write_classes_and_no_bigrams(spark, monkeypatch):
    import glob
    import os

    from colonnade.llm.text import Scratch
    from colonnade.session import local_path

    sizes: dict[str, int] = {}

    def watch(name):
        before = getattr(Scratch, name, None)

        def run(self, df, step, *more):
            out = before(self, df, step, *more)
            sizes[step] = sum(map(os.path.getsize, glob.glob(f"{local_path(self.paths[step])}/*.parquet")))
            return out

        if before:
            monkeypatch.setattr(Scratch, name, run)

    watch("write"), watch("write_bucketed")
    rng = np.random.default_rng(3)
    docs = [(i, " ".join(f"w{x}" for x in rng.integers(0, 20_000, 400)), i % 9 == 0) for i in range(500)]
    df = spark.createDataFrame(docs, "doc_id long, text string, held_out boolean")
    assert score_documents(df, classes=8).count() == 500
    assert all(size < sizes["bigrams"] / 2 for step, size in sizes.items() if step not in ("bigrams", "rows")), sizes


def test_cut_words_are_the_rule_s_words():
    import pyarrow as pa

    from colonnade.llm.lm_brown import cut_words
    from colonnade.llm.text import byte_words

    texts = ["x", None, "", " \t", "A b\x0bÄ c\x85d\x1ce A", "end\n", "next", "\rZ z"]
    for part in (slice(0, 8), slice(2, 7), slice(2, 4)):
        at = pa.array(texts).slice(part.start, part.stop - part.start)
        sizes, codes, words = cut_words(at)
        want = [byte_words(t, lower=True) for t in texts[part]]
        assert sizes.tolist() == [len(w) for w in want] and [words[c] for c in codes] == [w for ws in want for w in ws]


def test_blocks_count_like_the_texts():
    # Two chunks, three blocks, one frequent word: class counts from the blocks' messages against the texts'.
    import pandas as pd

    from colonnade.llm.lm_brown import Blocks

    rng = np.random.default_rng(5)
    every = np.sort(rng.integers(0, 2**63, 40, dtype=np.uint64))
    crc, cls = rng.integers(0, 2**32, 40, dtype=np.uint32), rng.integers(0, 4, 40)
    blocks = Blocks(every[[7]], 3, 4)
    sent, want, near = {}, np.zeros((6, 6)), np.zeros((2, 2, 128))
    for lo in (0, 10):
        h, sizes = every[lo:lo + 30], np.array([50, 0, 31, 200])
        ids, keep = rng.integers(0, 30, sizes.sum()), np.array([True, True, False, True])
        for row in blocks.send(ids, sizes, keep, h, crc[lo:lo + 30]):
            sent.setdefault(row[0], []).append(row)
        for text, on in zip(np.split(ids, np.cumsum(sizes)[:-1]), keep):
            seq = [None, *(text + lo), None]
            for a, b in zip(seq[:-1], seq[1:]) if on else ():
                if a not in (None, 7) and b not in (None, 7):
                    want[cls[a], cls[b]] += 1
                elif a not in (None, 7):
                    near[int(b is None), 1, cls[a]] += 1
                elif b not in (None, 7):
                    near[int(a is None), 0, cls[b]] += 1
    rows = [next(pd.DataFrame([blocks.build(r)]).itertuples()) for r in sent.values()]
    assert all((np.frombuffer(r.start, np.uint8) == crc[np.searchsorted(every, np.frombuffer(r.words, np.uint64))] % 4).all() for r in rows)
    spread = pd.concat([blocks.spread(r, cls[np.searchsorted(every, np.frombuffer(r.words, np.uint64))]) for r in rows])
    got = sum(blocks.cells(*blocks.entries(r, spread[spread["block"] == r.block])) for r in rows)
    assert (got[:36].reshape(6, 6) == want).all() and got[36:42].sum() == 39 and (got[42:].reshape(2, 2, 128) == near).all()


def test_exchange_finds_alternating_classes():
    # Words 0-4 are always followed by words 5-7 and the other way round (unequal sides: the even start is no saddle).
    big = np.zeros((9, 9))
    big[:5, 5:8] = 10
    big[5:8, :5] = 10
    cls = exchange(big, 8, 2)
    assert len(set(cls[:5])) == 1 and len(set(cls[5:8])) == 1 and cls[0] != cls[5]


def test_rare_words_are_clustered(spark):
    # All a- and b-words are rare and end alike; a-words follow x, b-words follow y.
    rows = [(i, f"x a{i % 40:02d}zz y b{i % 37:02d}zz", False) for i in range(400)]
    rows += [(1000, "x a05zz y b07zz", True), (1001, "x b07zz y a05zz", True), (1002, "x new y b07zz", True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    got = {r["doc_id"]: r for r in score_documents(df, frequent=0.05, classes=6).collect()}
    assert got[1000]["base_score"] == got[1001]["base_score"] and got[1000]["score"] > got[1001]["score"] + 1
    assert (got[1002]["n_tokens"], got[1002]["n_known"]) == (5, 4) and got[1002]["score"] < got[1000]["score"]


def test_licences(spark):
    rows = [(1, "Some words.\nReleased under the MIT License."), (2, None), (3, ""), (4, "Plain words with nothing else."),
            (5, "This work is licensed under the GNU General Public License, version 3.\nmore"), (1, "Some words.\nReleased under the MIT License.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["family"]) for r in scan_licences(df).collect())
    assert got == [
        (1, "mit"), (1, "mit"), (2, None), (3, None), (4, None), (5, "gpl")]
    assert scan_licences(df.limit(0)).count() == 0


IBANS = ("DE89370400440532013000", "FR1420041010050500013M02606", "ES9121000418450200051332", "GB29NWBK60161331926819",
         "IT60X0542811101000000123456", "NL91ABNA0417164300", "BE68539007547034", "AT611904300234573201",
         "CH9300762011623852957", "PT50000201231234567890154")


def test_ibans_of_every_listed_country_and_long_secrets(spark):
    for iban in IBANS:
        for said in (iban, " ".join(iban[i:i + 4] for i in range(0, len(iban), 4))):
            text = f"iban {said} EUR now"
            assert [(s, k, e) for s, k, e, _ in extra_candidates(text, []) if k == 1] == [(5, 1, 5 + len(said))], said
    assert [(s, e) for s, k, e, _ in extra_candidates("NO9386011117947 XK051212012345678906 I", []) if k == 1] == [(16, 36)]
    long = "sk" + "a1B2" * 150
    assert [(s, k, e) for s, k, e, _ in extra_candidates(f"token={long}.", [])] == [(6, 3, 6 + len(long))]
    assert extra_candidates("a" * 23 + " " + "a" * 1_000_000, []) == []
    df = spark.createDataFrame([(1, f"iban {IBANS[0]} now"), (2, f"token={long}.")], "doc_id long, text string")
    assert {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["found"]] for r in detect_pii(df).collect()} == {
        1: [("id", 5, 27)], 2: [("secret", 6, 6 + len(long))]}


def test_small_odd_source_is_judged_by_its_language(spark):
    rng = np.random.default_rng(3)
    said = lambda n, odd: " ".join(("#$%&|<>" if odd else "w") + "abcdefgh"[:rng.integers(3, 8)] + str(rng.integers(10**6)) for _ in range(n))
    rows = [(i, said(100, False), "en", "web") for i in range(300)] + [(1000 + i, said(100, True), "en", "odd") for i in range(5)]
    # 55 rows of a group that mostly fail the base rule do not make its five odd ones a big group.
    rows += [(2000 + i, said(100, True), "en", "thin") for i in range(5)] + [(3000 + i, "too short", "en", "thin") for i in range(50)]
    rows += [(4000 + i, said(100, False), "en", "fine") for i in range(5)]
    got = {r["doc_id"]: r["kept"] for r in mcd_outliers(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert {i for i, k in got.items() if k} == {*range(300), *range(4000, 4005)}


def test_licence_tiles_against_plain_python(spark):
    """Wrapped notices, near misses, notices inside long paragraphs; whatever is told holds half of a template's sequences."""
    from colonnade.llm.licences import CONTAINED, SEQUENCES, _grams, _plain

    filler = " ".join(f"filler{i}" for i in range(300))
    gnu = "you may use this under the terms of the GNU General\nPublic License as published by the Free Software\nFoundation. This program is free software: you can redistribute it and/or modify"
    texts = {1: f"{filler}\n\n{gnu}\n\n{filler}", 2: "All their hard won rights were reserved for the king.", 3: "The Apache people signed no license.",
             4: f"{filler} Released under the MIT License. {filler}", 5: "We read the GNU General and went home.", 6: None, 7: " \n\n \n", 8: "MIT is a place\n\nLicense plates",
             9: "Released under\nthe\nMIT\nLicense."}
    rows = list(texts.items()) + [(100 + i, f"plain text number {i} about the work is done") for i in range(40)]
    got = {r["doc_id"]: r for r in scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d: got[d]["family"] for d in texts} == {1: "gpl", 2: None, 3: None, 4: "mit", 5: None, 6: None, 7: None, 8: None, 9: "mit"}
    assert all(r["family"] is None for d, r in got.items() if d >= 100)
    for d, t in texts.items():
        for f in filter(None, (got[d]["families"] or "").split(",")):
            held = set(_grams(_plain(t)))
            assert max(len(held & set(g)) / len(g) for fam, g in SEQUENCES if fam == f) >= CONTAINED
