"""Streaming link ingestion equals the batch cleaning."""

import os

from quarry.operators import links
from quarry.sources import files
from quarry.streaming.links import ingest_links


def test_stream_ingest_matches_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "incoming")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("a\tb\n#c\td\nA\tB\nTalk:x\ty\n")
    with open(os.path.join(src, "b.txt"), "w") as f:
        f.write("Category:Q\tz\n b\ta \nx\n")
    out = os.path.join(tmp_dir, "edges")
    q = ingest_links(spark, src, out, name=os.path.basename(tmp_dir))
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in links.edge_set(spark.read.parquet(out)).collect())
    want = sorted(tuple(r) for r in links.edge_set(links.clean_links(files.read_lines(spark, src))).collect())
    assert got == want == [("a", "b"), ("b", "a"), ("category:q", "z")]
