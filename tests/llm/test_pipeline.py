"""The pipeline's stages, each on what its predecessor kept, against brute force."""

import importlib.util
import os

import corpus_pipeline as pipe
from colonnade.llm.packing_ss import encoder
from colonnade.llm.quality_mcd import mcd_outliers
from colonnade.llm.text import materialise
from colonnade.sources.tables import load_table

_spec = importlib.util.spec_from_file_location("llm_brute_pipe", os.path.join(os.path.dirname(__file__), "brute.py"))
brute = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(brute)

SF = "/root/testdata/sf0.001"


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_stages(spark):
    docs = load_table(spark, SF, "documents")
    at, before = docs, rows(docs)
    kept = {r["doc_id"] for r in mcd_outliers(docs).where("kept").collect()}
    out = {}
    for name, stage in pipe.STAGES:
        at = materialise(stage(spark, at, SF), "test-stage")
        after = out[name] = rows(at)
        if name == "quality rules":
            assert sorted(r["doc_id"] for r in after) == sorted(kept)
            assert not any(brute.op1(r["text"])[-1] for r in after) and len(after) > len(before) / 2
        elif name == "n-gram Jaccard join":
            ids, texts = [r["doc_id"] for r in before], [r["text"] for r in before]
            want = [d for d, (_, c) in zip(ids, brute.op8(ids, texts)) if d == c]
            assert sorted(r["doc_id"] for r in after) == sorted(want) and len(after) < len(before)
        elif name == "PII":
            assert [r["doc_id"] for r in sorted(after, key=lambda r: r["doc_id"])] == sorted(r["doc_id"] for r in before)
            found = {r["doc_id"]: brute.op4(r["text"])[:4] for r in before}
            assert all(brute.op4(r["text"])[:4] == (0, 0, 0, 0) for r in after)
            old = {r["doc_id"]: r["text"] for r in before}
            assert any(sum(v) for v in found.values()) and all(r["text"] != old[r["doc_id"]] for r in after if sum(found[r["doc_id"]]))
            assert all(r["n_chars"] == len(r["text"]) for r in after if r["text"] != old[r["doc_id"]])
        elif name == "mixing sources to target weights":
            times = {}
            for r in after:
                times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
            assert max(times.values()) <= 3 and set(times) <= {r["doc_id"] for r in before}
            total = sum(len(brute.words(r["text"])) for r in before)
            assert abs(sum(len(brute.words(r["text"])) for r in after) - total) < 0.2 * total
        else:
            encode = encoder()
            assert sum(r["length"] for r in after) == sum(len(encode(r["text"])) + 1 for r in before)
            fill = {}
            for r in after:
                fill.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
            for parts in fill.values():
                end = 0
                for o, n in sorted(parts):
                    assert o == end
                    end += n
                assert end <= 2048
        if name != "packing":
            assert at.columns == docs.columns
        before = after
    assert pipe.run(spark, SF).count() == len(out["packing"])


def test_stages_on_edge_rows(spark):
    """Nulls, empty and long texts, repeated rows, one id on two texts, extra columns, empty tables."""
    text = "one two three four five six seven eight nine ten eleven twelve a.b@example.org"
    schema = "doc_id long, text string, lang string, source string, n_chars int, k string, comp int"
    docs = spark.createDataFrame([(1, text, "en", "s", 80, "x", 1), (1, text, "en", "s", 80, "x", 1), (1, "w " * 30, None, "s", 60, "x", 2), (None, text, None, None, None, None, None),
                                  (2, None, None, "t", None, "y", 3), (3, "", "en", "t", 0, "y", 3), (4, "v" * 100_000 + " u" * 20_000, "en", "t", 1, "z", 4)], schema)
    for _, stage in pipe.STAGES:
        assert stage(spark, docs, SF).limit(0).count() == 0
        assert stage(spark, docs, SF).count() >= 0
        assert stage(spark, docs.limit(0), SF).count() == 0
