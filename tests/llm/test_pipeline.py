import zlib
from array import array

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.conftest import SMALL
from tests.llm.test_neardup import brute
from tests.llm.test_text import shingles
from viagrid.llm import rules


def test_stages_of_whole_tables(spark):
    """Each stage over its predecessor's rows, against brute force or the stage's own promise."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    before = docs
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = spark.createDataFrame(stage(spark, before, SMALL).collect(), docs.schema)
        assert after.columns == columns, name
        kept.append((name, [tuple(r) for r in before.collect()], [tuple(r) for r in after.collect()]))
        before = after
    (_, start, passed), (_, _, single), (_, _, clean), (_, _, mix) = kept
    verdict = rules.judged(docs, spark.read.parquet(f"{SMALL}/labels.parquet")).where("kept").collect()
    assert {r[0] for r in passed} == {r.doc_id for r in verdict} and set(passed) <= set(start)
    texts = {r[0]: r[1] for r in passed}
    roots = brute(list(texts.items()), 80)
    assert sorted(r[0] for r in single) == sorted(k for k in texts if roots[k][1] == k)
    items = [shingles(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    held = {r[0] for r in single if any(s and 100 * len(s & shingles(r[1])) >= 80 * len(s) for s in items)}
    assert sorted(r[0] for r in clean) == sorted(r[0] for r in single if r[0] not in held)
    assert set(mix) <= set(clean) and all(mix.count(r) <= 2 for r in set(mix))
    words, taken = (sum(len(r[1].encode().split()) for r in rows) for rows in (clean, mix))
    assert abs(taken - 1.5 * words) < 0.1 * words
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {r[0]: [*tokenizer.encode(r[1], add_special_tokens=False).ids, 1] for r in clean}
    found = corpus_pipeline.token_ids(spark, before, SMALL).orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted(r[0] for r in mix)
    at = 0
    for r in found:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids[r.doc_id]), zlib.crc32(array("I", ids[r.doc_id]).tobytes()))
        at += r.n_tokens


def test_run_equals_its_stages_and_no_rows(spark):
    assert corpus_pipeline.run(spark, SMALL).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    empty = spark.read.parquet(f"{SMALL}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0
