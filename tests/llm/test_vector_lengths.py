"""Embedding near-dedup of vectors of several lengths."""

from quiremill.llm import embedding_dedup


def test_vectors_link_within_their_length(spark, tmp_path):
    rows = [(1, [1.0, 2.0, 3.0, 4.0], 0), (2, [2.0, 4.0, 6.0, 8.0], 0), (3, [1.0, 2.0, 3.0, 4.0, 0.0], 0), (4, [1.0, 2.0, 3.0, 4.0], 1), (5, [1.0, 2.0, 3.0], 0), (6, [1.0, 2.0, 3.0], 0), (7, None, 0), (8, [1.0, 2.0, 3.0], None), (9, [], 0)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.op8_embedding_dedup(spark, str(tmp_path)).collect()}
    alone = {i: (0, i, True) for i in (3, 4, 7, 8, 9)}
    assert got == alone | {1: (1, 1, True), 2: (1, 1, False), 5: (1, 5, True), 6: (1, 5, False)}
