"""Source plug-ins: partitions, pruning, and plug-ins of one's own."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from presslens.sources import plugin as PL


def titles():
    """A plug-in that workers get by value: this module is not on their path."""

    class Titles(PL.PageSource):
        columns = "url string, letters int"
        needs = ("url", "html")

        @classmethod
        def name(cls):
            return "titles"

        def parse(self, pages):
            import pyarrow as pa

            assert pages.schema.names == ["url", "html"]
            kept = [(u, len(h)) for u, h in zip(pages.column(0).to_pylist(), pages.column(1).to_pylist()) if h]
            return pa.RecordBatch.from_arrays([pa.array([u for u, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int32())], ["url", "letters"])

    return Titles


def store(folder, n, rows=7):
    table = pa.table({"page_id": list(range(n)), "url": [f"u{i}" for i in range(n)], "html": [None if i % 5 == 0 else "<p>" + "x" * i for i in range(n)]})
    pq.write_table(table.slice(0, n // 2), f"{folder}/a.parquet", row_group_size=rows)
    pq.write_table(table.slice(n // 2), f"{folder}/b.parquet", row_group_size=rows)


def test_a_plug_in_of_ones_own(spark, tmp_dir):
    store(tmp_dir, 40)
    spark.dataSource.register(titles())
    df = spark.read.format("titles").option("path", tmp_dir).load()
    assert df.rdd.getNumPartitions() == 6  # row groups of two files
    assert {r.url: r.letters for r in df.collect()} == {f"u{i}": i + 3 for i in range(40) if i % 5}
    assert df.filter("letters > 40").count() == 2


def test_article_pages(spark, tmp_dir):
    store(tmp_dir, 12)
    spark.dataSource.register(PL.ArticlePages)
    got = {r.page_id: r.body for r in spark.read.format("article_pages").option("path", f"file://{tmp_dir}").load().collect()}
    assert got == {i: None if i % 5 == 0 else "x" * i for i in range(12)}
    with pytest.raises(Exception, match="path is missing"):
        spark.read.format("article_pages").load().count()


def test_empty_store(spark, tmp_dir):
    store(tmp_dir, 0)
    spark.dataSource.register(titles())
    assert spark.read.format("titles").option("path", tmp_dir).load().count() == 0
