import json

from quire.streaming import incremental


def test_stream_equals_batch(spark, tmp_path):
    page = [[{"type": "title", "bbox": [1, 2, 3, 4], "content": {"title_content": [{"type": "text", "content": "x"}]}}, {"type": "table", "bbox": [1, 2, 3, 4], "content": {}}], []]
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    rows = [("b", f"ch{i:02d}", json.dumps(page)) for i in range(4)]
    for part in (rows[:3], rows[3:]):
        spark.createDataFrame(part, incremental.FILES).coalesce(1).write.mode("append").parquet(src)
        q = incremental.run(incremental.page_files(spark, src, 1), incremental.block_counts, out, f"{tmp_path}/cp")
        q.awaitTermination(60)
        assert q.exception() is None
    got = spark.read.parquet(out).select("chapter", "blocks", "model_made").collect()
    assert sorted(map(tuple, got)) == [(f"ch{i:02d}", 2, 1) for i in range(4)]
