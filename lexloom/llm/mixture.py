"""Mixtures of sources to target weights, sized in tokens."""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.operators.ordering import running_totals
from lexloom.session import broadcast_if_small, materialise, ship, with_row

#: Where the vocabularies of public tokenizers lie.
TOKENIZER = os.environ.get("LEXLOOM_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: How that vocabulary cuts text into pieces before merging (a fixed value that belongs to it).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Tokens of a block, the unit that is drawn.
BLOCK_TOKENS = 1 << 18
#: Copies of a block that are laid out by one task at a time.
COPIES = 1 << 10
#: Blocks of one hypergeometric draw; more are drawn in groups of this many (the generator ends at 10^9).
DRAWN_AT_ONCE = 5 * 10**8
#: Tokens of an output shard.
SHARD_TOKENS = 1 << 25
#: Rows of the table of targets that the driver plans with.
MAX_SOURCES = 1_000_000


@lru_cache(maxsize=2)
def _encoding(path: str):
    import base64

    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, n_tokens) of each document; null text has none. One pass, no shuffle."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(tokenizer).encode_ordinary
        for batch in batches:
            tokens = pa.array([len(encode(t)) if t else 0 for t in batch.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), tokens], names=["doc_id", "source", "n_tokens"])

    ship(documents.sparkSession)
    return documents.select("doc_id", "source", "text").mapInArrow(counted, "doc_id bigint, source string, n_tokens bigint")


def split_quotas(quotas: np.ndarray, n_shards: int, seed: int, first: int = 0, last: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The splitting tree: (shard, quotas of that shard, quotas of all shards before it) for the shards from ``first`` to before ``last``.

    A node over shards [a, b) splits its quotas between its halves by a multivariate hypergeometric draw of as many blocks as
    the left half takes, seeded by the node alone; so any range of shards can be had anywhere, alike, by walking down to it.
    """
    total = int(quotas.sum())
    end = lambda s: total * s // n_shards
    last = n_shards if last is None else last
    nodes = [(0, n_shards, quotas.astype(np.int64), np.zeros(len(quotas), np.int64))]
    while nodes:
        a, b, have, before = nodes.pop()
        if b <= first or a >= last:
            continue
        if b - a == 1:
            yield a, have, before
            continue
        middle = (a + b) // 2
        left = _draw(have, end(middle) - end(a), np.random.default_rng([seed, a, b]))
        nodes += [(middle, b, have - left, before + left), (a, middle, left, before)]


def _draw(have: np.ndarray, n: int, draw: np.random.Generator, at_once: int = DRAWN_AT_ONCE) -> np.ndarray:
    """``n`` blocks out of ``have`` by source, a multivariate hypergeometric draw.

    Above ``at_once`` blocks these fall into groups with equal parts of each source, and each group gives its part of ``n`` by a
    draw of its own: exact in total, every block as likely as any other, with less spread between the halves.
    """
    total = int(have.sum())
    groups, left = max(1, -(-total // at_once)), np.zeros(len(have), np.int64)
    for k in range(groups):
        up_to = lambda m: np.array([int(h) * m // groups for h in have], np.int64)  # noqa: B023, E731
        group = up_to(k + 1) - up_to(k)
        a, b = int(up_to(k).sum()), int(up_to(k + 1).sum())
        wanted = n * b // total - n * a // total if total else 0
        if wanted:
            left += draw.multivariate_hypergeometric(group, wanted, method="marginals")
    return left


class Mixture:
    """A mixture of ``documents`` by ``targets`` (source, target_share, max_repeats), ``size`` tokens large (as all documents).

    With ``exact`` it is no larger than the size at which every source reaches its share, so the shares hold; without, sources that
    can't reach theirs stay at all their copies, and the others have what they should have of ``size``.

    Output shards hold about ``shard_tokens`` each, or are ``n_shards``. ``sizes`` measures documents in another unit than tokens.

    A source's quota is its share of the size, at most ``max_repeats`` times its own tokens. Documents fall into blocks of
    about ``block_tokens`` by a keyed hash; a quota is so many whole passes over the source and then blocks in permuted
    order, the last one cut after the document that reaches the quota. The splitting tree gives each output shard its exact
    number of blocks of each source, the blocks are dealt in permuted order, disjoint, and documents are shuffled within
    their shard. All draws depend on ``seed`` and keys only: a rerun, or a lost executor, gives the same mixture.

    Defined cases: documents of other or null sources, without doc_id or tokens are never drawn, but count in the size; a
    target without documents reaches nothing; null share or repeats count as 0; no documents: no draws, shares 0.
    """

    def __init__(self, documents: DataFrame, targets: DataFrame, *, tokenizer: str = TOKENIZER, size: int | None = None, exact: bool = False, seed: int = 1,
                 block_tokens: int = BLOCK_TOKENS, shard_tokens: int = SHARD_TOKENS, n_shards: int | None = None, sizes: Column | None = None) -> None:
        self.spark, self.seed, self.block_tokens, self.shard_tokens, self.n_shards = documents.sparkSession, seed, block_tokens, shard_tokens, n_shards
        sized = token_counts(documents, tokenizer) if sizes is None else documents.select("doc_id", "source", F.coalesce(sizes, F.lit(0)).cast("bigint").alias("n_tokens"))
        self.tokens = materialise(sized, "tokens")
        rows = targets.select("source", F.coalesce("target_share", F.lit(0.0)).alias("share"), F.coalesce("max_repeats", F.lit(0)).alias("repeats")).limit(MAX_SOURCES + 1).collect()
        if len(rows) > MAX_SOURCES:
            raise ValueError(f"more than {MAX_SOURCES} sources")
        wanted = self.spark.createDataFrame([(r["source"],) for r in rows], "source string")
        sums = self.tokens.groupBy("source").agg(F.sum("n_tokens").alias("n"))
        self.size = size if size is not None else int(sums.agg(F.sum("n")).first()[0] or 0)
        sizes = {r["source"]: r["n"] for r in sums.join(broadcast_if_small(wanted), "source").collect()}
        self.plan = pd.DataFrame([
            {"source": r["source"], "size_tokens": int(sizes.get(r["source"], 0)), "target_share": float(r["share"]), "max_repeats": int(r["repeats"])}
            for r in sorted(rows, key=lambda r: r["source"] or "")
        ], columns=["source", "size_tokens", "target_share", "max_repeats"])
        self.plan["most_tokens"] = self.plan.max_repeats * self.plan.size_tokens
        if exact:
            self.size = min([self.size, *(math.floor(most / Fraction(str(share))) for most, share in zip(self.plan.most_tokens, self.plan.target_share, strict=True) if share > 0)])
        # The smallest whole number that reaches the share, in exact arithmetic.
        self.plan["target_tokens"] = [math.ceil(Fraction(str(s)) * self.size) for s in self.plan.target_share]
        self.plan["quota_tokens"] = self.plan[["target_tokens", "most_tokens"]].min(axis=1).astype("int64")

    def _quotas(self) -> DataFrame:
        p = self.plan
        passes = np.where(p.size_tokens > 0, p.quota_tokens // p.size_tokens.clip(lower=1), 0)
        rest = p.quota_tokens - passes * p.size_tokens
        return self.spark.createDataFrame(
            [(s, int(a), int(b), int(max(1, -(-n // self.block_tokens)))) for s, a, b, n in zip(p.source, passes, rest, p.size_tokens, strict=True)],
            "source string, passes bigint, rest bigint, n_blocks bigint",
        )

    def _order(self, *parts: str | int):
        return F.xxhash64(F.lit(self.seed), *[F.col(x) if isinstance(x, str) else F.lit(x) for x in parts])

    def draws(self) -> DataFrame:
        """(shard, place, source, doc_id, copy_no, n_tokens): what each output shard holds and in which order; copies count from 1."""
        placed = self._placed()
        dealt = self.dealt(placed).withColumn("cut", (F.col("copy_no") > F.col("passes")) & (F.col("room") < F.col("block_size")))
        docs = placed.select("source", "block", "doc_id", "n_tokens").join(
            broadcast_if_small(dealt.select("source", "block", "copy_no", "shard", "room", "cut")), ["source", "block"]
        )
        within = Window.partitionBy("source", "block", "copy_no").orderBy("_key", "doc_id")
        last = docs.where("cut").withColumn("_key", self._order("doc_id", "copy_no")).withColumn(
            "_before", F.coalesce(F.sum("n_tokens").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        ).where(F.col("_before") < F.col("room")).select(*docs.columns)
        drawn = docs.where(~F.col("cut")).unionByName(last)
        shuffled = Window.partitionBy("shard").orderBy("_key", "doc_id", "copy_no")
        return drawn.withColumn("_key", self._order("shard", "doc_id", "copy_no")).select(
            "shard", F.row_number().over(shuffled).alias("place"), "source", "doc_id", "copy_no", "n_tokens"
        )

    def _placed(self) -> DataFrame:
        """The documents that may be drawn, with their block."""
        known = self.tokens.where(F.col("doc_id").isNotNull() & (F.col("n_tokens") > 0)).join(broadcast_if_small(self._quotas()), "source")
        return known.withColumn("block", F.pmod(F.xxhash64(F.lit(self.seed), F.lit("block"), "doc_id"), F.col("n_blocks")))

    def dealt(self, placed: DataFrame) -> DataFrame:
        """(source, block, copy_no, passes, room, block_size, shard): every copy of a block that the mixture takes, and where it goes.

        Blocks in permuted order, and then their copies in permuted order, are counted by ranges; no window runs over a source.
        A copy's place in that order falls into the stretch that the tree gives to one shard.
        """
        blocks = placed.groupBy("source", "passes", "rest", "block").agg(F.sum("n_tokens").alias("block_size"))
        blocks = running_totals(blocks.withColumn("_order", F.struct(F.col("source"), self._order("source", "block").alias("key"), F.col("block"))), "_order", {"_before": F.col("block_size")})
        firsts = blocks.groupBy("source").agg(F.min("_before").alias("_first"))
        room = F.greatest(F.col("rest") - (F.col("_before") - F.col("_first")), F.lit(0))
        wanted = blocks.join(broadcast_if_small(firsts), "source").withColumn("room", room).withColumn("_copies", F.col("passes") + F.when(F.col("room") > 0, 1).otherwise(0)).where("_copies > 0")
        # Many copies of few blocks: laid out in stretches, spread before they are written out.
        stretches = wanted.withColumn("_start", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"), F.lit(COPIES).cast("bigint")))).repartition("source", "block", "_start")
        copies = stretches.withColumn("copy_no", F.explode(F.sequence("_start", F.least(F.col("_start") + COPIES - 1, F.col("_copies"))))).select("source", "block", "block_size", "passes", "room", "copy_no")
        ordered = copies.withColumn("_order", F.struct(F.col("source"), self._order("source", "block", "copy_no").alias("key"), F.col("block"), F.col("copy_no")))
        ranked = materialise(running_totals(ordered, "_order", {"_place": F.lit(1).cast("bigint")}).drop("_order"), "copies")
        return ranked.join(self._stretches(ranked), "_place").drop("_place")

    def _stretches(self, ranked: DataFrame) -> DataFrame:
        """(_place, shard) of every copy of a block: each shard takes a stretch of each source, as long as the tree's quota."""
        found = ranked.groupBy("source").agg(F.count("*").alias("n"), F.min("_place").alias("first")).orderBy("source").collect()
        quotas, firsts = np.array([r["n"] for r in found], np.int64), np.array([r["first"] for r in found], np.int64)
        n_shards, seed = self.shards(), self.seed

        def expanded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for shard, have, before in split_quotas(quotas, n_shards, seed, int(batch.id.min()), int(batch.id.max()) + 1) if len(batch) else ():
                    some = have > 0
                    yield pd.DataFrame({"shard": np.full(int(some.sum()), shard), "start": (firsts + before)[some], "n": have[some]})

        leaves = self.spark.range(0, n_shards).mapInPandas(expanded, "shard bigint, start bigint, n bigint")
        return leaves.select("shard", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("_place"))

    def shards(self) -> int:
        return self.n_shards or int(max(1, self.plan.quota_tokens.sum() // self.shard_tokens))

    def violations(self) -> DataFrame:
        """(rule, n_violations) of everything a mixture promises; all 0.

        Per source its quota is met to within its last document; no document is used more often than its source allows, none
        of its copies twice; every copy of a block lies in one shard; shards hold equally many blocks to within one; each shard
        has of every source the blocks that the tree says; places within a shard count from 1 without gaps.
        """
        draws = materialise(self.draws(), "draws")
        rule = lambda name, found: found.agg(F.count("*").alias("n_violations")).select(F.lit(name).alias("rule"), "n_violations")
        plan = self.spark.createDataFrame([(p.source, int(p.quota_tokens), int(p.max_repeats)) for p in self.plan.itertuples()], "source string, quota bigint, cap bigint")
        got = draws.groupBy("source").agg(F.sum("n_tokens").alias("got"), F.max("n_tokens").alias("largest"))
        met = plan.join(got, "source", "left").fillna(0, ["got", "largest"])
        per_document = draws.groupBy("source", "doc_id").agg(F.count("*").alias("n"), F.count_distinct("copy_no").alias("n_copies")).join(broadcast_if_small(plan), "source")
        dealt = materialise(self.dealt(self._placed()), "dealt")
        by_shard = dealt.groupBy("shard").agg(F.count("*").alias("n")).agg(F.max("n").alias("most"), F.min("n").alias("least"), F.count("*").alias("n_shards"), F.sum("n").alias("total"))
        quotas = [(r["source"], r["n"]) for r in dealt.groupBy("source").agg(F.count("*").alias("n")).orderBy("source").collect()]
        have, n_shards, seed = np.array([n for _, n in quotas], np.int64), self.shards(), self.seed

        def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for shard in batch.id:
                    for _, held, _ in split_quotas(have, n_shards, seed, int(shard), int(shard) + 1):
                        yield pd.DataFrame([(shard, s, int(k)) for (s, _), k in zip(quotas, held, strict=True) if k], columns=["shard", "source", "wanted"])

        told = self.spark.range(0, n_shards).mapInPandas(leaves, "shard bigint, source string, wanted bigint")
        held = dealt.groupBy("shard", "source").agg(F.count("*").alias("held"))
        in_shard = draws.groupBy("shard").agg(F.count("*").alias("n"), F.min("place").alias("least"), F.max("place").alias("most"), F.count_distinct("place").alias("n_places"))
        out = [
            rule("quota met to within a document", met.where((F.col("got") < F.col("quota")) | ((F.col("got") > 0) & (F.col("got") >= F.col("quota") + F.col("largest"))))),
            rule("document used no more than allowed", per_document.where(F.col("n") > F.col("cap"))),
            rule("no copy of a document twice", per_document.where(F.col("n") > F.col("n_copies"))),
            rule("no copy of a block twice", dealt.groupBy("source", "block", "copy_no").count().where("count > 1")),
            rule("shards alike in blocks", by_shard.where((F.col("most") - F.least(F.col("least"), F.when(F.col("n_shards") < n_shards, 0).otherwise(F.col("least"))) > 1))),
            rule("blocks of shards as the tree says", told.join(held, ["shard", "source"], "full").where(~F.col("wanted").eqNullSafe(F.col("held")))),
            rule("places without gaps", in_shard.where((F.col("least") != 1) | (F.col("most") != F.col("n")) | (F.col("n_places") != F.col("n")))),
        ]
        found = out[0]
        for more in out[1:]:
            found = found.unionByName(more)
        return found

    def plan_frame(self) -> DataFrame:
        """Per source its size, target and quota."""
        kinds = {"source": "string", "size_tokens": "bigint", "target_share": "double", "max_repeats": "int", "target_tokens": "bigint", "most_tokens": "bigint", "quota_tokens": "bigint"}
        return self.spark.createDataFrame(self.plan[list(kinds)].values.tolist(), ", ".join(f"{name} {kind}" for name, kind in kinds.items()))

    def report(self, draws: DataFrame) -> DataFrame:
        """The plan with what the mixture holds of each source: tokens, share, most copies of a document."""
        plan = self.plan_frame()
        got = draws.groupBy("source").agg(F.sum("n_tokens").alias("drawn_tokens"), F.count("*").alias("n_documents"), F.max("copy_no").alias("most_copies"))
        total = got.agg(F.sum("drawn_tokens").alias("_total"))
        return with_row(plan.join(broadcast_if_small(got), "source", "left"), total).select(
            *plan.columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("drawn_tokens", "n_documents", "most_copies")],
            F.coalesce(F.col("drawn_tokens") / F.col("_total"), F.lit(0.0)).alias("actual_share"),
        )


def unreachable(report: DataFrame) -> DataFrame:
    """Sources of a ``report`` that fell short of their target in the mixture, because all their copies are less than it."""
    return report.where((F.col("drawn_tokens") < F.col("target_tokens")) & (F.col("most_tokens") < F.col("target_tokens"))).select("source")
