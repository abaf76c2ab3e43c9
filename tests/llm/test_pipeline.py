"""The pipeline's stages on the small table and on edge cases, and the registered queries."""

import hashlib
import re
import zlib
from collections import Counter

from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from barlake.llm import bpe, language, neardup
from barlake.llm.queries import QUERIES, token_digests, tokenizer_path
from tests.llm import test_decontaminate, test_language, test_line_dedup, test_neardup
from tests.llm.conftest import SF

NATIVE = ("op5", "op7", "op8", "op10")


def test_stages(spark, documents):
    docs, counts = documents, [documents.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "tokens":
            assert out.columns == documents.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] == counts[-2] > counts[0] // 2
    run = {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()}
    assert run == {tuple(r) for r in docs.collect()}


def test_run_against_plain_python(spark, documents):
    """The rows of run() from plain-Python versions of all five stages, one after the other."""
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in documents.collect()]
    # 1: nearest profile, learned from the documents that are not held out
    profiles = {}
    for i, text, name in docs:
        if zlib.crc32(str(i).encode()) % 5 and name is not None:
            profiles.setdefault(name, Counter()).update(test_language.grams(text))
    profiles = {k: {g: n for n, g in enumerate(test_language.ranked(v, language.TOP))} for k, v in profiles.items()}
    kept = []
    for i, text, _ in docs:
        own = test_language.ranked(test_language.grams(text), language.TOP)
        far = min((sum(abs(p[g] - n) if g in p else language.TOP for n, g in enumerate(own)) for p in profiles.values()), default=0)
        if own and 1.0 - far / (language.TOP * len(own)) >= corpus_pipeline.MIN_SCORE:
            kept.append((i, text))
    # 2: later three-line windows go; documents of which nothing is left go
    clean = test_line_dedup.brute(kept)
    kept = [(i, clean[i, t][0]) for i, t in kept if not clean[i, t][2] or clean[i, t][2] < clean[i, t][1]]
    # 3: one document of each class of similar texts
    frame = spark.createDataFrame(kept, "doc_id long, text string")
    classes = test_neardup.brute_classes(kept, neardup.inverse_frequencies(frame, "text"))
    kept = [(i, t) for i, t in kept if classes[i] == i]
    # 4: no benchmark passage in a twentieth of the words
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = [d for d, (*_, bad) in zip(kept, test_decontaminate.brute([t for _, t in kept], items, 13)) if not bad]
    # 5: tokens by the library
    library = Tokenizer.from_file(tokenizer_path())
    library.no_truncation()
    library.no_padding()
    want = []
    for i, text in kept:
        ids = library.encode(text, add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), back)]
        want.append((i, len(ids), *digest))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(want)
    assert len(docs) // 2 < len(want) < len(docs)


def test_edges(spark, edges):
    docs = edges.withColumnRenamed("kept", "source").selectExpr("*", "CAST(length(text) AS bigint) AS n_chars")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() >= 0
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_one_tokenizer_worker_a_task(spark):
    """No task of the token stage runs the encoder's and the decoder's Python worker side by side."""
    rows = [(None, None, "a"), (1, "", "a"), (2, "Two words", "a"), (2, "Two words", "b"), (3, None, "c"), (4, "日本 🙂 <|endoftext|>\n", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = corpus_pipeline.token_stage(spark, docs, SF)
    assert len(re.findall("ArrowEvalPython", out._jdf.queryExecution().executedPlan().toString())) == 1
    path = tokenizer_path()
    want = token_digests(bpe.decode(bpe.encode(docs, path), path))
    assert out.schema == want.schema
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))


def test_registered():
    assert set(QUERIES) <= set(entry.queries())
    assert all(any(k.startswith(f"op{n}_") for k in QUERIES) for n in range(1, 14)) and "pipeline" in QUERIES


def test_native_queries_run_no_python(spark):
    for name, query in QUERIES.items():
        if name.split("_")[0] in NATIVE:
            plan = query(spark, SF)._jdf.queryExecution().toString()
            assert not re.search("EvalPython|MapIn|Pandas|ArrowUDF|InMemoryRelation|InMemoryTableScan", plan), name
