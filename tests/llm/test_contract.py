"""Contract queries against brute force on the smallest tables, and DuckDB for those with SQL."""

import duckdb
import pytest
import importlib.util
import os

import __spark_entry__ as entry

_spec = importlib.util.spec_from_file_location("llm_brute", os.path.join(os.path.dirname(__file__), "brute.py"))
brute = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(brute)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text, source FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def got(spark, name, *cols):
    return {r[0]: tuple(r[1:]) for r in entry.queries()[name](spark, SF).select("doc_id", *cols).collect()}


def test_op1(spark, docs):
    g = got(spark, "op1_quality_mcd", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert {d: v[:-1] for d, v in g.items()} == {d: brute.op1(t) for d, t, _ in docs}
    assert not any(v[-1] and v[-2] for v in g.values()) and sum(v[-1] for v in g.values()) > 0.5 * len(g)


def test_op2(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: [*tk.encode(t or "", add_special_tokens=False).ids, 1] for d, t, _ in docs}
    rows = entry.queries()["op2_packing_ss"](spark, SF).collect()
    docs_at, seqs = {}, {}
    for r in rows:
        assert r["ids_crc32"] == brute.crc(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]) and r["doc_tokens"] == len(ids[r["doc_id"]])
        docs_at.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))

    def gapless(parts):
        at = 0
        for s, n in sorted(parts):
            assert s == at and n > 0
            at += n
        return at
    assert {d: gapless(p) for d, p in docs_at.items()} == {d: len(i) for d, i in ids.items()}
    fills = [gapless(p) for p in seqs.values()]
    assert max(fills) <= 2048 and all(f & (f - 1) == 0 for f in fills)


def test_op4(spark, docs):
    g = got(spark, "op4_pii_weak", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    assert g == {d: brute.op4(t) for d, t, _ in docs}


def test_op5(spark, docs):
    g = got(spark, "op5_mixing_pareto", "size", "source_size", "target", "taken")
    again = got(spark, "op5_mixing_pareto", "size", "source_size", "target", "taken")
    assert g == again
    size = {d: len(brute.words(t)) for d, t, _ in docs}
    by = {}
    for d, _, s in docs:
        by[s] = by.get(s, 0) + size[d]
    names = sorted(by, key=lambda s: (s is None, s))
    w = {s: i % 3 + 1 for i, s in enumerate(names)}
    capped, left = set(), sum(by.values())
    while True:
        free = [s for s in names if s not in capped]
        level = (left - sum(3 * by[s] for s in capped)) / sum(w[s] for s in free)
        new = {s for s in free if level * w[s] > 3 * by[s]}
        if not new:
            break
        capped |= new
    target = {s: 3 * by[s] if s in capped else level * w[s] for s in names}
    largest = {s: max(size[d] for d, _, x in docs if x == s) for s in names}
    taken = dict.fromkeys(names, 0)
    for d, _, s in docs:
        assert g[d][0] == size[d] and g[d][1] == by[s] and abs(g[d][2] - target[s]) < 1e-6 * (1 + target[s]) and g[d][3] <= 3 * size[d]
        taken[s] += g[d][3]
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in names)


def test_op6(spark, docs):
    g = got(spark, "op6_substring_windows", "n_words", "n_removed", "kept_sha256")
    want = dict(zip([d for d, *_ in docs], brute.op6([t for _, t, _ in docs])))
    assert g == want


def test_op8(spark, docs):
    g = got(spark, "op8_jaccard_tiles", "n_shingles", "component_id")
    assert g == dict(zip([d for d, *_ in docs], brute.op8([d for d, *_ in docs], [t for _, t, _ in docs])))


@pytest.mark.parametrize("name", ["op7_url_rules", "op9_topk_columnar"])
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    want = con.execute(entry.oracle_sql()[name]).fetchdf()
    rows = sorted((tuple(map(str, r)) for r in df.select(*want.columns).collect()))
    assert rows == sorted(tuple(map(str, r)) for r in want.astype(object).where(want.notna(), None).itertuples(index=False, name=None))
