"""Exact duplicates by deterministic block naming.

A text's UTF-8 bytes are cut into blocks of ``BLOCK`` bytes.  The distinct
blocks of all texts are sorted and numbered, which gives every block an integer
name: equal blocks have equal names and different ones never do.  Then each
document's names are taken by adjacent pairs (a last odd one pairs with -1),
the distinct pairs are sorted and numbered, and so on until every document has
one name.  The names halve with each round, so all rounds together move about
as many integers as there are blocks.  (round, last name) is the document's
identity: texts of equal identity are equal byte for byte, no digest decides.

What moves: the distinct blocks once (every task combines its copies first, so
a block that stands in a third of all rows is one row of each task), then only
integers.  A document refers to its blocks by two 64-bit hashes.  That this
reference is one to one is checked on the named blocks; if two different blocks
share a reference, all are referred to anew under other seeds.  Names, identities
and groups are written tables, so the joins that attach them can split the
occurrences of a frequent one.

Names are unique but depend on the number of tasks; only their equality is used.
Only DataFrame functions: no Python runs on rows.

Defined cases: a null text counts as empty and equals an empty one; an empty
text is one empty block.  Rows with equal id and equal text are rows of their
own, one of them stays.  A null id counts as the least; in a group of null ids
only, one row stays and ``keep_id`` is null.  Long texts take more rounds, the
logarithm of their blocks.  An empty table gives an empty result.
``exact_duplicates`` reads no other column than the two it is told of, and
``drop_exact_duplicates`` returns all columns as they are, whatever their names.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, functions as F

from cohortlake.llm.common import stored

#: Bytes of a block.
BLOCK = 2048


def reference(block: Column, salt: int) -> list[Column]:
    """128 bits that refer to a block."""
    return [F.xxhash64(F.lit(2 * salt + i), block) for i in (0, 1)]


def _block(text: Column, i: Column, size: int) -> Column:
    """The ``i``-th block of a binary column; byte slices do not walk the text."""
    return F.substring(text, (i * size + 1).cast("int"), F.lit(size))


def _block_numbers(text: Column, size: int) -> Column:
    return F.sequence(F.lit(0), (F.greatest(F.ceil(F.length(text) / F.lit(size)), F.lit(1)) - 1).cast("int"))


def _numbered(distinct: DataFrame, key: list[str]) -> DataFrame:
    """Distinct rows sorted in their tasks and numbered there (write it once: numbers hold for one run)."""
    return distinct.sortWithinPartitions(*key).withColumn("name", F.monotonically_increasing_id())


def _named_blocks(texts: DataFrame, size: int, refer) -> tuple[int, DataFrame]:
    """(salt, (r1, r2, name)): the names of all distinct blocks under a salt that tells them apart."""
    cut = texts.select("bytes", F.explode(_block_numbers(F.col("bytes"), size)).alias("i"))
    blocks = cut.select(_block(F.col("bytes"), F.col("i"), size).alias("block"))
    for salt in count():
        r1, r2 = refer(F.col("block"), salt)
        distinct = blocks.select("block", r1.alias("r1"), r2.alias("r2")).groupBy("r1", "r2", "block").agg(F.count(F.lit(1)).alias("n"))
        names = stored(_numbered(distinct, ["block"]).select("r1", "r2", "name"), "dedup-blocks")
        if names.groupBy("r1", "r2").count().where("count > 1").isEmpty():
            return salt, names


def _paired(places: DataFrame) -> DataFrame:
    """Adjacent names of a document as (a, b); ``n`` is the number of names that it has."""
    even = F.col("pos") % 2 == 0
    return (
        places.where("n > 1")
        .groupBy("row", F.shiftright("pos", 1).alias("half"), F.shiftright(F.col("n") + 1, 1).alias("left"))
        .agg(F.max(F.when(even, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"))
        .select("row", F.col("half").alias("pos"), F.col("left").alias("n"), "a", "b")
    )


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row: Column | None = None, block: int = BLOCK, refer=reference) -> DataFrame:
    """(row, id, sha256, round, name): every document's identity, as a written table.

    ``row`` numbers the rows; without it they are numbered as they are read.
    ``refer`` gives two hash columns for a block and a salt.
    """
    binary = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("bytes")
    salt, names = _named_blocks(docs.select(binary), block, refer)
    numbered = docs.select((F.monotonically_increasing_id() if row is None else row).alias("row"), F.col(id_col).alias("id"), binary)
    refs = F.transform(_block_numbers(F.col("bytes"), block), lambda i: F.struct(*[x.alias(f"r{k}") for k, x in enumerate(refer(_block(F.col("bytes"), i, block), salt), 1)]))
    rows = stored(numbered.select("row", "id", F.sha2("bytes", 256).alias("sha256"), refs.alias("refs")), "dedup-rows")

    longest = rows.agg(F.max(F.size("refs"))).first()[0] or 1
    places = rows.select("row", F.size("refs").alias("n"), F.posexplode("refs").alias("pos", "ref")).select("row", "pos", "n", "ref.*")
    places = stored(places.join(names, ["r1", "r2"]).select("row", "pos", "n", "name"), "dedup-places-0")
    found = places.where("n = 1").select("row", F.lit(0).alias("round"), "name")
    for k in range(1, (longest - 1).bit_length() + 1):
        pairs = stored(_paired(places), f"dedup-pairs-{k}")
        names = stored(_numbered(pairs.select("a", "b").distinct(), ["a", "b"]), f"dedup-names-{k}")
        places = stored(pairs.join(names, ["a", "b"]).select("row", "pos", "n", "name"), f"dedup-places-{k}")
        found = found.unionByName(places.where("n = 1").select("row", F.lit(k).alias("round"), "name"))
    return stored(rows.select("row", "id", "sha256").join(found, "row"), "dedup-identities")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row: Column | None = None, **options) -> DataFrame:
    """(row, id, sha256, keep_id, group_size, kept) of every document.

    Of equal texts the row with the largest id stays, of equal ids the first row.
    """
    members = identities(docs, id_col, text_col, row, **options)
    best = F.max(F.struct("id", (-F.col("row")).alias("back")))
    groups = stored(members.groupBy("round", "name").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best")), "dedup-groups")
    return members.join(groups, ["round", "name"]).select(
        "row", "id", "sha256", F.col("best.id").alias("keep_id"), "group_size", (F.col("row") == -F.col("best.back")).alias("kept"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    at = "row"
    while at in docs.columns:
        at += "_"
    numbered = stored(docs.withColumn(at, F.monotonically_increasing_id()), "dedup-input")
    kept = exact_duplicates(numbered, id_col, text_col, F.col(at), **options).where("kept").select(F.col("row").alias(at))
    return numbered.join(kept, at, "left_semi").select(*docs.columns)
