"""Merkle fixity audit of archive replicas.

A record is ``(file, offset, length, digest)`` with the SHA-256 of its bytes. The
offsets of a file are cut into ranges of RANGE bytes; a range is hashed over its
records' offsets, lengths and digests in order, FANOUT ranges are hashed into
the range above, up to one root per file. Replicas are compared root by root;
below a mismatch only the children of mismatching ranges are compared, down to
the records. Ranges hold a bounded number of bytes and inner nodes at most
FANOUT children, so nothing grows with a file.

Null payloads count as empty; records of a null file form one file of their own;
records that repeat file and offset are hashed together in order of their
digests. A file or record that only one replica has is a mismatch. Empty
replicas are equal. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proteoframe.llm.base import store

RANGE = 65_536
FANOUT = 16


def warc_record(url: Column, record_id: Column, body: Column) -> Column:
    """Bytes of a response record."""
    body = F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nWARC-Record-ID: <urn:record:"), F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(">\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body,
        F.lit("\r\n\r\n")).cast("binary")


def digested(records: DataFrame, file: str = "file", offset: str = "offset", payload: str = "payload") -> DataFrame:
    """``file, offset, length, digest`` of every record; payloads go no further."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    return records.select(F.coalesce(F.col(file).cast("string"), F.lit("")).alias("file"),
                          F.col(offset).cast("long").alias("offset"), F.octet_length(body).cast("long").alias("length"),
                          F.sha2(body, 256).alias("digest"))


#: Range of a record; those without an offset are a range of their own.
_NODE = f"coalesce(offset div {RANGE}, -1)"


def _levels(top: int) -> int:
    """Levels above the ranges until one node covers offsets up to ``top``."""
    n, width = 1, RANGE * FANOUT
    while width <= top:
        n, width = n + 1, width * FANOUT
    return n


def tree(records: DataFrame, levels: int) -> DataFrame:
    """All nodes ``replica, level, file, node, hash`` of the trees over digested records with ``replica``."""
    item = F.struct("offset", "length", "digest")
    leaf = (records.groupBy("replica", "file", F.expr(_NODE).alias("node"))
            .agg(F.sort_array(F.collect_list(item)).alias("items")))
    text = F.array_join(F.transform("items", lambda x: F.concat_ws(":", x["offset"], x["length"], x["digest"])), "\n")
    now = store(leaf.select("replica", F.lit(0).alias("level"), "file", "node", F.sha2(text, 256).alias("hash")))
    out = now
    for level in range(1, levels + 1):
        kids = F.sort_array(F.collect_list(F.struct("node", "hash")))
        above = (now.groupBy("replica", "file", F.expr(f"node div {FANOUT}").alias("up")).agg(kids.alias("kids")))
        text = F.array_join(F.transform("kids", lambda x: F.concat_ws(":", x["node"], x["hash"])), "\n")
        now = store(above.select("replica", F.lit(level).alias("level"), "file", F.col("up").alias("node"),
                                 F.sha2(text, 256).alias("hash")))
        out = out.union(now)
    return out


def roots(nodes: DataFrame, levels: int) -> DataFrame:
    """Root hash of every file and replica."""
    return nodes.filter(F.col("level") == levels).select("replica", "file", "hash")


def _mismatches(nodes: DataFrame, level: int, below: DataFrame | None) -> DataFrame:
    """Nodes of one level that differ, among the children of ``below`` if given."""
    here = nodes.filter(F.col("level") == level)
    if below is not None:
        here = here.withColumn("up", F.expr(f"node div {FANOUT}")).join(below, ["file", "up"], "left_semi")
    left, right = (here.filter(F.col("replica") == r).select("file", "node", F.col("hash").alias(r)) for r in "ab")
    return (left.join(right, ["file", "node"], "full").filter(~F.col("a").eqNullSafe(F.col("b")))
            .select("file", F.col("node").alias("up")))


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """Records that differ between two replicas (as ``digested`` gives them).

    ``file, offset, range, kind`` (changed, missing or extra in the second),
    ``length_a, length_b, digest_a, digest_b``.
    """
    both = store(first.withColumn("replica", F.lit("a")).unionByName(second.withColumn("replica", F.lit("b"))))
    levels = _levels(both.agg(F.max("offset")).first()[0] or 0)
    nodes = tree(both, levels)
    bad = None
    for level in range(levels, -1, -1):
        bad = _mismatches(nodes, level, bad)
    ranged = both.withColumn("up", F.expr(_NODE)).join(store(bad), ["file", "up"], "left_semi")
    item = F.sort_array(F.collect_list(F.struct("length", "digest")))
    # Null offsets are equal to each other; every other offset is told apart from them.
    place = ["file", "known", "at", "up"]
    one = ranged.groupBy("replica", "file", F.col("offset").isNotNull().alias("known"),
                         F.coalesce("offset", F.lit(0)).alias("at"), "up").agg(item.alias("items"))
    left, right = (one.filter(F.col("replica") == r).select(*place, F.col("items").alias(r)) for r in "ab")
    pairs = left.join(right, place, "full").withColumn("offset", F.when(F.col("known"), F.col("at"))).filter(~F.col("a").eqNullSafe(F.col("b")))
    kind = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("changed")
    return pairs.select(
        "file", "offset", F.col("up").alias("range"), kind.alias("kind"),
        F.get("a.length", F.lit(0)).alias("length_a"), F.get("b.length", F.lit(0)).alias("length_b"),
        F.array_join("a.digest", ",").alias("digest_a"), F.array_join("b.digest", ",").alias("digest_b"))
