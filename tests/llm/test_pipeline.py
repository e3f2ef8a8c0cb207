"""The pipeline's stages, one after the other, each held against its operator."""

import collections

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from conftest import SF
from stratafold.llm import common, packing, simhash
from test_operators import library, plain_bm25, windows_of  # noqa: F401

import __spark_entry__ as entry


def test_registered_queries():
    names = [f"op{n}_" for n in range(1, 14)]
    found = list(entry.queries())
    assert all(sum(q.startswith(n) for q in found) == 1 for n in names) and "pipeline" in found
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages(spark):
    docs = common.table(spark, SF, "documents")
    columns, before, groups = docs.columns, docs, None
    for name, stage in corpus_pipeline.STAGES:
        after = common.stored(stage(spark, before, SF), name)
        if name != "packed":
            assert after.columns == columns
            assert after.join(before, "doc_id", "left_anti").count() == 0
        if name == "language_id":
            assert after.where("trim(text) = ''").count() == 0
        if name == "near_duplicates":
            groups = simhash.near_groups(before)
            assert after.count() == groups.select("component_id").distinct().count() < before.count()
        if name == "mixture":
            assert 0 < after.count() < before.count()
        if name == "packed":
            want = {tuple(r) for r in packing.pack(before).collect()}
            assert {tuple(r) for r in after.collect()} == want
        before = after


def test_packed_windows_hold_the_seeds_best_documents(spark, library):  # noqa: F811
    """The last stage's windows: after the first document, each one is the best unused document of the table for it."""
    docs = common.table(spark, SF, "documents").limit(120)
    texts = {r.doc_id: r.text for r in docs.collect()}
    row = {key: i for i, key in enumerate(texts)}
    scores, unused, others = plain_bm25(list(texts.values()), library), set(texts), 0
    for (seed, start), *rest in windows_of(corpus_pipeline.packed(spark, docs, SF).collect(), 2048):
        unused -= {seed} if start == 0 else set()
        for doc, _ in rest:
            assert scores[row[seed]][row[doc]] >= max(scores[row[seed]][row[i]] for i in unused) * (1 - 1e-5)
            unused.remove(doc)
            others += 1
    assert not unused and others > 40


def whole(pieces):
    """The documents whose pieces stand end to end, and their lengths."""
    of = collections.defaultdict(list)
    for r in pieces:
        of[r.doc_id, r.doc_tokens].append((r.start, r.length))
    for (_, tokens), parts in of.items():
        assert sum(n for _, n in parts) % tokens == 0 and min(parts)[0] == 0
    return collections.Counter(i for i, _ in of)


@pytest.mark.parametrize("rows", [0, 1])
def test_run_on_tiny_tables(spark, tmp_path, rows):
    for name in ("documents", "labels"):
        common.table(spark, SF, name).limit(rows).write.parquet(f"{tmp_path}/{name}.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert sum(whole(found.collect()).values()) <= rows


def test_run_on_odd_rows(spark, tmp_path):
    """Null texts and ids, ids that repeat on several texts, and columns of the operators' own names."""
    docs = common.table(spark, SF, "documents")
    some = docs.where("doc_id < 20")
    odd = (docs.unionByName(some.withColumn("text", F.lit(None).cast("string")))
           .unionByName(some.withColumn("doc_id", F.lit(None).cast("bigint")))
           .unionByName(some.withColumn("text", F.reverse("text"))).unionByName(some))
    odd.selectExpr("*", "1 fingerprint", "'x' mix_kept", "2.5D quality_pred", "text lang_ambiguous").write.parquet(
        f"{tmp_path}/documents.parquet")
    common.table(spark, SF, "labels").write.parquet(f"{tmp_path}/labels.parquet")
    found = whole(corpus_pipeline.run(spark, str(tmp_path)).collect())
    known = {r.doc_id for r in docs.collect()}
    assert found and set(found) <= known | {None}
