"""The pipeline's stages against brute-force versions of each, on their own input."""

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.rows import AWKWARD, clashing, collected, documents
from tests.llm.test_exact_dedup import brute as brute_exact
from tests.llm.test_qgram_decontam import brute as brute_leaks
from tests.llm.test_simhash import brute_components, brute_fingerprint
from tidemark.llm import bpe_tree, pairwise_quality, qgram_decontam
from tidemark.llm.text import held_out


def pairs(rows):
    return [(row["doc_id"], row["text"]) for row in rows.collect()]


def test_stages_on_the_given_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, labels = docs.columns, spark.read.parquet(f"{SMALL}/labels.parquet")
    rejected = {
        row["doc_id"] for row in pairwise_quality.scores(docs, labels).where("predicted = 0").collect()
    }
    kept = dict(pairs(docs))
    expected = {i for i in kept if i not in rejected}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns
        rows = sorted((i, kept[i]) for i in expected)
        if name == "exact dedup":
            expected = {row[0] for row in brute_exact(rows) if row[3]}
        if name == "SimHash near-dedup":
            least = {}
            for i, text in rows:
                least.setdefault(brute_fingerprint(text), i)
            root = brute_components({i: bits for bits, i in least.items()}, 4)
            expected = {i for i, text in rows if root[least[brute_fingerprint(text)]] == i}
        if name == "benchmark decontamination":
            items = [
                (row["item_id"], row["text"])
                for row in spark.read.parquet(f"{SMALL}/benchmark.parquet").limit(6).collect()
            ]
            short = [(i, text) for i, text in rows if len(text) < 400]
            leaks = {i for i, _, _ in brute_leaks(short, items, qgram_decontam.EDIT_RATE)}
            found = set(i for i, _ in pairs(docs))
            assert leaks.isdisjoint(found) and found < expected
            whole = {i for i, text in rows if any(item in text for _, item in items)}
            assert whole.isdisjoint(found)
            expected = found
        assert {i for i, _ in pairs(docs)} == expected, name
    final = corpus_pipeline.tokenize(spark, docs, SMALL).collect()
    library = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe_tree.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")),
        special_tokens={},
    )
    assert {row["doc_id"]: row["n_tokens"] for row in final} == {
        i: len(library.encode_ordinary(kept[i])) for i in expected
    }


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert collected(corpus_pipeline.run(spark, SMALL)) == collected(docs)


def test_every_stage_takes_awkward_and_empty_tables(spark):
    for table in (clashing(spark), documents(spark, [])):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, SMALL)
            assert out.columns == table.columns
            assert out.count() <= len(AWKWARD)
        assert corpus_pipeline.tokenize(spark, table, SMALL).count() == table.count()


def test_quality_stage_learns_from_rows_that_a_draw_would_leave_out(spark, tmp_path):
    """All poor rows lie beyond the 20,000 that were once drawn by a hash of the id."""
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 20))
    taught = spark.range(32_000).where(~held_out(F.col("id"), 4))
    ids = [row["id"] for row in taught.orderBy(draw, "id").collect()]
    good, poor = ids[:20_000], ids[20_000:]
    text = {i: f"This is text {i} written with care." for i in good}
    text |= {i: f"## {i} || $$ BUY!! 00 ((" for i in poor}
    labels = [(i, 1, 0) for i in good] + [(i, 0, 0) for i in poor]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    frame.write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.quality(spark, documents(spark, text.items()), str(tmp_path))
    assert len(poor) > 3000 and {row["doc_id"] for row in kept.collect()} == set(good)
