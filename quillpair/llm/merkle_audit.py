"""WARC fixity audit with Merkle trees.

Every record of a replica's archive files is hashed; a file's records, ordered by their key, are the leaves of a tree
whose nodes cover ranges of FANOUT children: a node hashes its children's hashes and the bytes of their ranges, so it
vouches for an ordered range of offsets. Two replicas compare their roots, one row per file. Only below nodes that
differ are the children compared, level by level, down to the records; a sound file costs one comparison. Leaves are
keyed by record and not by offset, so a lost or shortened record changes its own path alone, although it moves every
later offset in that file.

Records are the rows of a page table, rendered as WARC response records; a file holds the records of FILE_RECORDS
consecutive ids. A null id counts as -1, null url and html as empty. Repeated ids make one leaf that counts its
copies and covers all their bytes. A file that one replica lacks is reported record by record. Empty tables give no
rows, and neither do equal replicas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

FANOUT_BITS = 4
LEVELS = 3
#: Consecutive ids of one file: as many as the leaves of a tree with LEVELS levels above them.
FILE_RECORDS = 1 << (FANOUT_BITS * LEVELS)


def warc_records(pages: DataFrame) -> DataFrame:
    """(record, body): each page as the text of one WARC response record."""
    html = F.coalesce("html", F.lit(""))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce("url", F.lit("")),
                    F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce("page_id", F.lit(-1)).cast("string"),
                    F.lit(">\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"))
    return pages.select(F.coalesce("page_id", F.lit(-1)).cast("bigint").alias("record"),
                        F.concat(head, html, F.lit("\r\n\r\n")).alias("body"))


def leaves(records: DataFrame) -> DataFrame:
    """(file, idx, copies, size, digest, at): one row per record key, with its offset in the file."""
    each = records.select("record", F.sha2("body", 256).alias("digest"),
                          F.octet_length("body").cast("bigint").alias("size"))
    one = each.groupBy("record").agg(
        F.count("*").alias("copies"), F.sum("size").alias("size"), F.min("digest").alias("low"),
        F.max("digest").alias("high"), *(F.sum(F.conv(F.substring("digest", at, 16), 16, 10).cast("decimal(20,0)"))
                                         .cast("string").alias(f"sum{at}") for at in (1, 17, 33)))
    # A single copy is its digest; several are told apart by a digest over sums, which any order gives and in which
    # equal copies don't cancel.
    digest = F.when(F.col("copies") == 1, F.col("low")).otherwise(
        F.sha2(F.concat_ws(" ", "copies", "low", "high", "sum1", "sum17", "sum33"), 256))
    file = F.floor(F.col("record") / F.lit(FILE_RECORDS)).cast("bigint")
    before = Window.partitionBy("file").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    return (one.select(file.alias("file"), (F.col("record") - file * FILE_RECORDS).alias("idx"), "copies", "size",
                       digest.alias("digest"))
            .withColumn("at", F.coalesce(F.sum("size").over(before), F.lit(0))))


def tree(leaf: DataFrame) -> list[DataFrame]:
    """Levels of the trees of all files, leaves first; each has (file, idx, digest, size)."""
    levels = [leaf.select("file", "idx", "digest", "size")]
    for _ in range(LEVELS):
        below = levels[-1].select("file", F.shiftright("idx", FANOUT_BITS).alias("idx"),
                                  F.struct(F.col("idx").alias("child"), "digest", "size").alias("c"))
        # At most 2**FANOUT_BITS children a node.
        nodes = below.groupBy("file", "idx").agg(F.sort_array(F.collect_list("c")).alias("cs"),
                                                 F.sum("c.size").alias("size"))
        text = F.array_join(F.transform("cs", lambda c: F.concat_ws(" ", c["child"], c["digest"], c["size"])), "\n")
        levels.append(nodes.select("file", "idx", F.sha2(text, 256).alias("digest"), "size"))
    return levels


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """Records in which two replicas (record, body) differ: file, record, kind, and offset, size, digest in each."""
    a, b = (written(leaves(r), "merkle-leaves") for r in (first, second))
    suspects = None
    for x, y in reversed(list(zip(tree(a), tree(b)))):
        if suspects is not None:  # only children of nodes that differ
            parent = F.shiftright("idx", FANOUT_BITS).alias("parent")
            x, y = (t.select("*", parent).join(suspects, ["file", "parent"], "left_semi") for t in (x, y))
        differ = (x.select("file", "idx", F.col("digest").alias("da"), F.col("size").alias("sa"))
                  .join(y.select("file", "idx", F.col("digest").alias("db"), F.col("size").alias("sb")),
                        ["file", "idx"], "full")
                  .filter("NOT (da <=> db AND sa <=> sb)"))
        suspects = written(differ.select("file", F.col("idx").alias("parent")), "merkle-suspects")
    found = suspects.select("file", F.col("parent").alias("idx"))

    def of(leaf: DataFrame, tag: str) -> DataFrame:
        return leaf.select("file", "idx", F.col("at").alias(f"offset_{tag}"), F.col("size").alias(f"size_{tag}"),
                           F.col("digest").alias(f"digest_{tag}"))

    return (found.join(of(a, "a"), ["file", "idx"], "left").join(of(b, "b"), ["file", "idx"], "left")
            .select("file", (F.col("file") * FILE_RECORDS + F.col("idx")).alias("record"),
                    F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra")
                    .otherwise("changed").alias("kind"),
                    "offset_a", "size_a", "digest_a", "offset_b", "size_b", "digest_b"))


def damaged_replica(pages: DataFrame) -> DataFrame:
    """A second replica for a table that has none: the same pages with known damage, by id.

    Ids that leave 13 when divided by 97 have their first character replaced, 7 of 89 lose the second half, and
    records with 5 of 101 are lost.
    """
    p = F.col("page_id")
    html = (F.when(F.pmod(p, F.lit(97)) == 13, F.expr("concat('~', substring(html, 2))"))
            .when(F.pmod(p, F.lit(89)) == 7, F.expr("substring(html, 1, char_length(html) div 2)"))
            .otherwise(F.col("html")))
    return pages.filter(F.coalesce(F.pmod(p, F.lit(101)), F.lit(0)) != 5).select("page_id", "url", html.alias("html"))
