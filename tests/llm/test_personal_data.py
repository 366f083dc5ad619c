"""Counts of op9 by kind, against patterns read by Python."""

from __future__ import annotations

import hashlib

from glebe.llm.queries import QUERIES

ROWS = [
    (1, "write to a@b.co and c.d@e.org, or e@f.net", (3, 0, 0, 0), "email:9:15,email:20:29,email:34:41"),
    (2, "hosts 10.0.0.1 and 10.0.0.2", (0, 2, 0, 0), "ip:6:14,ip:19:27"),
    (3, "card 4111 1111 1111 1111", (0, 0, 1, 0), "card:5:24"),
    (4, "call +1 212 555 1234", (0, 0, 0, 1), "phone:5:20"),
    (5, "a@b.co at 10.0.0.1, 4111111111111111, +1 212 555 1234", (1, 1, 1, 1), "email:0:6,ip:10:18,card:20:36,phone:38:53"),
    (6, "1.2.3.4 1.2.3.4 a@b.co", (1, 2, 0, 0), "ip:0:7,ip:8:15,email:16:22"),
    (7, "nothing", (0, 0, 0, 0), ""),
    (8, None, (0, 0, 0, 0), ""),
]


def test_spans_are_counted_by_kind_not_by_position(spark, tmp_path):
    spark.createDataFrame([r[:2] for r in ROWS], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op9_personal_data"](spark, str(tmp_path)).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    assert {tuple(r) for r in got.collect()} == {(i, *n, hashlib.sha256(spans.encode()).hexdigest()) for i, _, n, spans in ROWS}
