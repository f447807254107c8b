"""Rows that differ only in formatting or in the order of their fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.functions.text import letters_and_digits
from lexloom.session import materialise

#: No more groups than this can each hold more than a 256th of all rows, so their list may be broadcast.
HOT_GROUPS = 256

NULL, ITEM, PAIR, FIELD = "\x00", "\x01", "\x02", "\x03"


def canonical(c: Column, kind: T.DataType) -> Column:
    """A value as text: strings by their letters and digits, lists and maps without regard to order; null is unlike any value."""
    if isinstance(kind, T.StringType):
        text = letters_and_digits(c)
    elif isinstance(kind, T.ArrayType):
        text = F.concat(F.lit("["), F.array_join(F.array_sort(F.transform(c, lambda x: F.concat(F.lit(ITEM), canonical(x, kind.elementType)))), ""))
    elif isinstance(kind, T.MapType):
        pair = lambda e: F.concat(F.lit(ITEM), canonical(e["key"], kind.keyType), F.lit(PAIR), canonical(e["value"], kind.valueType))
        text = F.concat(F.lit("{"), F.array_join(F.array_sort(F.transform(F.map_entries(c), pair)), ""))
    elif isinstance(kind, T.StructType):
        fields = [canonical(c[f.name], f.dataType) for f in sorted(kind.fields, key=lambda f: f.name)]
        text = F.concat(F.lit("("), F.concat_ws(PAIR, *fields))
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(NULL))


def hashed(df: DataFrame, id_column: str, ignore: Sequence[str] = (), whole: bool = False) -> DataFrame:
    """(id, h1, h2, check): 128 bits of hash and a check (length and CRC-32) of each row's canonical text, fields in order of name; with ``whole`` the row too (row)."""
    fields = sorted((f for f in df.schema.fields if f.name != id_column and f.name not in ignore), key=lambda f: f.name)
    text = F.concat_ws(FIELD, *[canonical(F.col(f"`{f.name}`"), f.dataType) for f in fields])
    row = [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")] if whole else []
    return df.select(F.col(id_column).alias("id"), text.alias("_text"), *row).select(
        "id", *(["row"] if whole else []), F.xxhash64("_text").alias("h1"), F.xxhash64(F.lit("second"), "_text").alias("h2"),
        (F.length("_text").cast("bigint") * F.lit(1 << 32) + F.crc32("_text")).alias("check"),
    )


class FormatDuplicates:
    """Groups of rows of one table that agree in all fields but ``id_column`` and those in ``ignore``.

    Rows are reduced to 32 bytes (id, 128-bit hash, check), written once to the shared folder, and counted per hash with
    map-side combining; all keys are fixed-width. Rows of one hash with another check (a collision) stay apart and are
    reported by ``collisions``. Members find their group through a join in which the groups that hold more than a 256th of
    all rows - at most 256 - are broadcast, so that no task gets more than that share of one group.

    Defined cases: null equals only null; empty strings, lists and maps equal each other but not null; repeated list entries
    count; rows with a null id are counted but never listed as copies; empty tables give empty results.
    """

    def __init__(self, df: DataFrame, id_column: str, ignore: Sequence[str] = ()) -> None:
        self.df, self.id_column, self.ignore = df, id_column, ignore
        self.rows = materialise(hashed(df, id_column, ignore), "hashed")
        self.groups = self.rows.groupBy("h1", "h2", "check").agg(F.min("id").alias("first_id"), F.count("*").alias("n_copies"))

    def members(self) -> DataFrame:
        """(first_id, copy_id) for each member of a group but the first."""
        several = self.groups.where(F.col("n_copies") > 1)
        most = max(1, self.rows.count() // HOT_GROUPS)
        hot, rest = several.where(F.col("n_copies") > most), several.where(F.col("n_copies") <= most)
        key = ["h1", "h2", "check"]
        marked = self.rows.join(F.broadcast(hot.select(*key, F.col("first_id").alias("hot_id"))), key, "left")
        in_hot = marked.where(F.col("hot_id").isNotNull()).select(F.col("hot_id").alias("first_id"), "id")
        in_rest = marked.where(F.col("hot_id").isNull()).drop("hot_id").join(rest.select(*key, "first_id"), key).select("first_id", "id")
        return in_hot.unionByName(in_rest).where(F.col("id") != F.col("first_id")).select("first_id", F.col("id").alias("copy_id"))

    def collapsed(self) -> DataFrame:
        """One whole row of each group, that of the smallest id, with ``n_copies``, its number of rows (a column of that name is replaced).

        Of a group whose ids are all null, the row that comes first as JSON stands for it; of rows with one id and one text, all stay.
        """
        plain, key = self.df.drop("n_copies"), ["h1", "h2", "check"]
        counts = self.groups.where(F.col("first_id").isNotNull()).select(F.col("first_id").alias(self.id_column), "n_copies")
        unnamed = hashed(self.df.where(F.col(self.id_column).isNull()), self.id_column, self.ignore, whole=True).join(self.groups.where(F.col("first_id").isNull()).drop("first_id"), key)
        chosen = unnamed.groupBy(*key).agg(F.min_by("row", F.to_json("row")).alias("row"), F.max("n_copies").alias("_copies"))
        return plain.join(counts, self.id_column).select(*plain.columns, "n_copies").unionByName(chosen.select(*[F.col(f"row.`{c}`").alias(c) for c in plain.columns], F.col("_copies").alias("n_copies")))

    def collisions(self) -> DataFrame:
        """Hashes that more than one text has."""
        return self.groups.groupBy("h1", "h2").agg(F.count("*").alias("n_texts")).where(F.col("n_texts") > 1)
