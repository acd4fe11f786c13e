import pyarrow.parquet as pq

from eventlake.llm.tables import stored, table


def _largest_row_group(df):
    files = [pq.ParquetFile(f.removeprefix("file://")) for f in df.inputFiles()]
    groups = [f.metadata.row_group(k) for f in files for k in range(f.metadata.num_row_groups)]
    return max(sum(g.column(c).total_compressed_size for c in range(g.num_columns)) for g in groups)


def _texts(spark, rows=6_000):
    text = "array_join(transform(sequence(1, 80), x -> sha2(concat(id, '-', x), 512)), '') AS text"
    return spark.range(0, rows, 1, 1).selectExpr("id", text)


def test_stored_tables_have_small_row_groups(spark):
    rows = stored(_texts(spark), "wide")
    assert rows.count() == 6_000
    assert _largest_row_group(rows) < 20 << 20  # one group of 30 MB before


def test_tables_written_by_others_in_the_session_have_small_row_groups(spark, tmp_path):
    """The pipeline's runner writes a stage's rows itself."""
    table(spark, "/root/testdata/sf0.001", "labels")
    _texts(spark).write.parquet(str(tmp_path / "out"))
    assert _largest_row_group(spark.read.parquet(str(tmp_path / "out"))) < 20 << 20  # one of 58 MB before
