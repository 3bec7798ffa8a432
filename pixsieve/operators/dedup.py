"""Order-dependent near-duplicate removal that keeps the better of two similar rows.

Rows are taken in input order. A row is compared with the rows kept so far and matched to the
first of them (in input order) whose cosine reaches the threshold. Without a match it is kept.
Otherwise the one with the strictly higher quality stays and the other is rejected; a
newcomer that wins takes its own place in the order. This is not "best of each cluster".

The rule is sequential, but a row only depends on its neighbours, so it is worked out in
rounds over the whole table:

* rows with the same vector form one group (found by content hash, pre-aggregated), and all
  vector products are between groups, so exact copies cost one vector however many there are;
* groups without neighbours and without copies survive and leave at once; copies without other
  neighbours, and large components in which every row is similar to every other, have one kept row at any
  time and are settled by a running maximum, cut into bounded chunks, whatever the order of their qualities;
* a kept row is certain to be alive up to its first undecided better neighbour, and a row can
  be decided as soon as its first kept neighbour is certain and no earlier undecided row could
  come before it. Every round decides all such rows. Among copies in no particular order of
  quality the number of rounds grows with the logarithm of the group size.

Rows of different components of the similarity graph never meet, so each round also replays the
next ``tail_rows`` undecided rows of every component in input order, small components together, in many
tasks of bounded size. That settles every component of up to ``tail_rows`` rows at once; a larger one that is not
complete takes at most its size divided by ``tail_rows`` rounds, however its qualities are ordered.

Kept rows that died before the first undecided row of their component are forgotten, and new
kept rows are compared once, with the groups that still have undecided rows.

Rows are never paired with each other, only with rows that were kept. Every round ends in
written tables, so lineage stays short and a lost executor costs one stage.
"""

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pixsieve import schema as S
from pixsieve.functions import quality_score
from pixsieve.operators import similarity as sim
from pixsieve.operators.components import components
from pixsieve.session import scratch_path, write_table
from pixsieve.sources.manifest import dense_index

TAIL_ROWS = 20_000
CHUNK_ROWS = 1_000_000
HOT_ROWS = 100_000
INFINITE = float("inf")
NEVER = 2**63 - 1
NEAR_ROWS = 256
_PAIR_LAYOUT = (
    "duplicate_idx bigint, kept_idx bigint, similarity double, "
    "duplicate_quality double, kept_quality double"
)


def _beats(challenger: Column, incumbent: Column) -> Column:
    """Strictly greater, with NaN beating nothing."""
    return (challenger > incumbent) & ~F.isnan(challenger)


def _by_key(df: DataFrame) -> DataFrame:
    """``df`` for a join that meets by sorted keys.

    The tables of a round are often small enough for a broadcast, but each of those passes through the driver, in every round.
    """
    return df.hint("merge")


def _hot_parts(count: Column, rows: int) -> Column:
    """Into how many parts a key of ``count`` rows is salted: 1 below a thousandth of all rows."""
    return F.ceil(count / F.lit(max(HOT_ROWS, rows // 1000))).cast("int")


@dataclass
class _Tables:
    """State between rounds; each member is a written table or a plain view on one."""

    undecided: DataFrame   # idx, q, gid, salt, comp, pos
    groups: DataFrame      # gid, parts, lb: no undecided neighbour row lies before lb
    kept: DataFrame        # k, w (its group), q_k, dead (idx of the row that replaced it), comp


class _Growing:
    """A written table that each round adds a part to."""

    def __init__(self, spark: SparkSession, label: str, layout: str):
        self.spark, self.layout, self.parts = spark, layout, 0
        self.path = scratch_path(spark, label)

    def add(self, df: DataFrame) -> DataFrame:
        part = f"{self.path}/part={self.parts}"
        df.write.parquet(part)
        self.parts += 1
        return self.spark.read.schema(self.layout).parquet(part)

    def table(self) -> DataFrame:
        if self.parts == 0:
            return self.spark.createDataFrame([], self.layout)
        return self.spark.read.schema(f"{self.layout}, part int").parquet(self.path).drop("part")


def _settle_complete(members: DataFrame, contested: DataFrame) -> DataFrame:
    """The rule for components in which all rows are similar to each other, without rounds.

    There the kept row is always the first one with the highest quality so far. A component is cut
    into chunks of ``CHUNK_ROWS`` row numbers: windows run inside a chunk and over the bests of
    the chunks, so no task holds a component.
    """
    cut = members.withColumn("chunk", F.floor(F.col("idx") / CHUNK_ROWS))
    # NaN wins against nothing, and nothing wins against a NaN that came first.
    rank = F.when(~F.isnan("q"), F.col("q")).when(F.col("idx") == F.col("comp"), INFINITE).otherwise(-INFINITE)
    standing = cut.withColumn("s", F.struct(rank.alias("rank"), (-F.col("idx")).alias("neg"), "q", "gid"))
    bests = standing.groupBy("comp", "chunk").agg(F.max("s").alias("best"))
    chunks = Window.partitionBy("comp").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = bests.select("comp", "chunk", F.max("best").over(chunks).alias("before"))
    inside = Window.partitionBy("comp", "chunk").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    holder = F.greatest("before", F.max("s").over(inside))
    held = standing.join(_by_key(before), ["comp", "chunk"]).withColumn("h", holder).filter("h is not null")
    held = write_table(held.select(
        "idx", "q", "gid", F.col("h.gid").alias("other"), (-F.col("h.neg")).alias("k"), F.col("h.q").alias("q_k"),
        F.when(_beats(F.col("q"), F.col("h.q")), "wins").otherwise("loses").alias("fate"),
    ), "held")
    copies = held.filter("gid = other").withColumn("similarity", F.lit(1.0))
    others = held.filter("gid <> other")
    cosines = sim.checked(others.select("gid", "other").distinct(), contested, -INFINITE)
    return _pairs_of(copies.unionByName(others.join(_by_key(cosines), ["gid", "other"])))


def _prepare(
    df: DataFrame, vector: str, threshold: float, block: int, cell_rows: int, tail_rows: int = TAIL_ROWS
):
    """Contested groups with their vectors, and their rows.

    ``comp`` is the component of a row, ``pos`` a row number that counts through the components in
    input order. A component is ``complete`` if all its rows are similar to each other and it either is a single group
    of copies or has more than ``tail_rows`` rows (smaller ones take one replay).
    """
    units = write_table(
        sim.unit_vectors(df, vector, threshold).withColumn("key", F.sha2("unit", 256)), "units"
    )
    rows = units.count()
    pivots = sim.choose_pivots(units, "idx", rows, threshold, cell_rows, sim.MOST_COPIES)
    sizes = units.groupBy("key").agg(F.min("idx").alias("gid"), F.count(F.lit(1)).alias("copies"))
    representatives = units.select(F.col("idx").alias("gid"), "unit", "key").join(
        _by_key(sizes.select("gid", "copies")), "gid"
    )
    vectors = write_table(sim.assign_cells(representatives, pivots, threshold), "vectors")
    links = write_table(sim.neighbour_links(vectors, threshold, block), "links")
    nearest = links.groupBy("gid").agg(F.min("nbr").alias("nbr"), F.sum("ends").alias("ends"))
    roots = components(links.select(F.col("gid").alias("a"), F.col("nbr").alias("b"))).withColumnRenamed("node", "gid")
    contested = write_table(
        vectors.join(_by_key(nearest), "gid", "left")
        .filter(F.col("nbr").isNotNull() | (F.col("copies") > 1))
        .withColumn("lb", F.least("gid", "nbr"))
        .withColumn("parts", _hot_parts(F.col("copies"), rows)).drop("nbr")
        .join(_by_key(roots), "gid", "left").withColumn("comp", F.coalesce("root", "gid")).drop("root"),
        "contested",
    )
    # Similar pairs of a component against all its pairs: ``ends`` counts each from both sides.
    whole = contested.groupBy("comp").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("ends", F.lit(0))).alias("ends"), F.sum("copies").alias("rows")
    ).select("comp", (
        (F.col("n") == 1) | ((F.col("ends") == F.col("n") * (F.col("n") - 1)) & (F.col("rows") > tail_rows))
    ).alias("complete"))
    contested = write_table(contested.drop("ends").join(_by_key(whole), "comp"), "contested")
    # Keys with more than a thousandth of all rows: at most a thousand, so they broadcast.
    hot = F.broadcast(contested.filter("parts > 1").select("key", "parts"))
    salted = units.select("idx", "q", "key").join(hot, "key", "left").withColumn(
        "salt", F.pmod(F.xxhash64("idx"), F.coalesce("parts", F.lit(1))).cast("int")
    ).drop("parts")
    members = salted.join(
        _by_key(_salted(contested.select("key", "gid", "parts", "lb", "complete", "comp"))), ["key", "salt"]
    ).select("idx", "q", "gid", "salt", "lb", "complete", "comp")
    members = write_table(dense_index(members, ["comp", "idx"], "pos"), "members")
    return contested, members


def _salted(per_group: DataFrame) -> DataFrame:
    return per_group.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))


def _active(contested: DataFrame, groups: DataFrame) -> DataFrame:
    return contested.join(_by_key(groups.select("gid")), "gid", "left_semi").select(
        "gid", "unit", "home", "outer"
    )


def _kept_near(edges: DataFrame, kept: DataFrame) -> DataFrame:
    """Per group the kept rows its members may be matched to.

    A kept row may neighbour very many groups; the adaptive skew join splits the edge side.
    """
    return edges.join(_by_key(kept), edges.other == kept.w).drop("other", "w", "comp")


def _decide(state: _Tables, edges: DataFrame) -> DataFrame:
    """One row per undecided row with its fate: fresh, wins, loses or waits."""
    usable = (F.col("k") < F.col("idx")) & (F.col("dead").isNull() | (F.col("dead") > F.col("idx")))
    alive = _kept_near(edges, state.kept.filter("dead is null")).join(
        _by_key(state.groups.select("gid", "parts")), "gid"
    )
    threats = state.undecided.join(_by_key(_salted(alive)), ["gid", "salt"]).filter(
        (F.col("k") < F.col("idx")) & _beats(F.col("q"), F.col("q_k"))
    )
    horizon = threats.groupBy("k").agg(F.min("idx").alias("until"))
    near = _kept_near(edges, state.kept.join(_by_key(horizon), "k", "left"))
    known = state.groups.join(_by_key(near), "gid", "left")
    match = F.min(F.when(usable, F.struct("k", "q_k", "similarity", "until", "dead"))).alias("m")
    best = (
        state.undecided.join(_by_key(_salted(known)), ["gid", "salt"])
        .groupBy("idx", "q", "gid", "salt", "lb", "comp", "pos").agg(match)
        .select("idx", "q", "gid", "salt", "lb", "comp", "pos", "m.k", "m.q_k", "m.similarity", "m.until", "m.dead")
    )
    # A row known to die later was certain up to its death.
    certain = F.col("dead").isNotNull() | F.col("until").isNull() | (F.col("until") >= F.col("idx"))
    settled = F.col("k").isNotNull() & (F.col("k") <= F.col("lb")) & certain
    fate = (
        F.when(settled & _beats(F.col("q"), F.col("q_k")), "wins")
        .when(settled, "loses")
        .when(F.col("k").isNull() & (F.col("lb") == F.col("idx")), "fresh")
        .otherwise("waits")
    )
    return best.withColumn("fate", fate)


def _pairs_of(decided: DataFrame) -> DataFrame:
    won = F.col("fate") == "wins"

    def pick(yes: str, no: str) -> Column:
        return F.when(won, F.col(yes)).otherwise(F.col(no))

    return decided.filter(F.col("fate").isin("wins", "loses")).select(
        pick("k", "idx").alias("duplicate_idx"), pick("idx", "k").alias("kept_idx"),
        "similarity",
        pick("q_k", "q").alias("duplicate_quality"), pick("q", "q_k").alias("kept_quality"),
    )


def _next_kept(kept: DataFrame, decided: DataFrame, undecided: DataFrame) -> DataFrame:
    """Kept rows that an undecided row may still meet: alive at the first one of their component."""
    deaths = decided.filter("fate = 'wins'").select("k", F.col("idx").alias("died"))
    born = decided.filter("fate in ('wins', 'fresh')").select(
        F.col("idx").alias("k"), F.col("gid").alias("w"), F.col("q").alias("q_k"),
        F.lit(None).cast("bigint").alias("dead"), "comp",
    )
    # A replayed row may be born and beaten in one go.
    standing = kept.unionByName(born).join(_by_key(deaths), "k", "left").withColumn("dead", F.coalesce("dead", "died"))
    first = undecided.groupBy("comp").agg(F.min("idx").alias("first"))
    return standing.join(_by_key(first), "comp").filter("dead is null or dead > first").select(
        "k", "w", "q_k", "dead", "comp"
    )


def _next_groups(
    state: _Tables, contested: DataFrame, threshold: float, block: int
) -> DataFrame:
    """Groups that still have undecided rows, with ``lb`` moved up where its row is decided."""
    undecided = state.undecided
    first = undecided.groupBy("gid").agg(F.min("idx").alias("value"))
    pending = undecided.select(F.col("idx").alias("_idx"))
    groups = write_table(
        state.groups.join(_by_key(first), "gid").join(_by_key(pending), F.col("lb") == F.col("_idx"), "left")
        .select("gid", "parts", "lb", "value", F.col("_idx").isNull().alias("stale")),
        "groups",
    )
    stale = groups.filter("stale")
    if stale.isEmpty():
        return groups.select("gid", "parts", "lb")
    remaining = contested.select("gid", "unit", "home", "outer").join(
        _by_key(groups.select("gid", "value")), "gid"
    )
    nearest = sim.smallest_neighbours_among(
        _active(contested, stale), remaining, threshold, block
    )
    moved = stale.join(_by_key(nearest), "gid", "left").select(
        "gid", F.least("value", "nbr").alias("new_lb")
    )
    return write_table(
        groups.join(_by_key(moved), "gid", "left").select(
            "gid", "parts", F.coalesce("new_lb", "lb").alias("lb")
        ),
        "bounds",
    )


class _Near:
    """Kept rows that the groups of a replay task neighbour: columns sorted by group and row, not a Python object per row."""

    def __init__(self, kept: pa.Table, groups: np.ndarray):
        kept = kept.sort_by([("gid", "ascending"), ("k", "ascending")])
        self.k, self.q_k, self.similarity = (kept[c].to_numpy() for c in ("k", "q_k", "similarity"))
        gid = kept["gid"].to_numpy()
        self.starts, self.ends = np.searchsorted(gid, groups), np.searchsorted(gid, groups, side="right")
        # A row dies for all groups at once.
        rows, self.row = np.unique(self.k, return_inverse=True)
        self.dead = np.empty(len(rows), np.int64)
        self.dead[self.row] = kept["dead"].fill_null(NEVER).to_numpy()

    def first(self, group: int, idx: int) -> int | None:
        """Place of the first kept row of a group that lies before ``idx`` and is alive there."""
        for start in range(self.starts[group], self.ends[group], NEAR_ROWS):
            part = slice(start, min(start + NEAR_ROWS, self.ends[group]))
            found = np.flatnonzero((self.k[part] < idx) & (self.dead[self.row[part]] > idx))
            if len(found):
                return start + int(found[0])
        return None

    def dies(self, place: int, idx: int) -> None:
        self.dead[self.row[place]] = idx


def _replay_task(threshold: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(rows: pa.Table, kept: pa.Table) -> pa.Table:
        rows = rows.sort_by("idx")
        idx, q, gid = (rows[c].to_numpy() for c in ("idx", "q", "gid"))
        groups, firsts, place = np.unique(gid, return_index=True, return_inverse=True)
        vectors = sim.matrix_of(rows["unit"].take(pa.array(firsts)))
        near = _Near(kept, groups)
        born = np.empty(0, dtype=int)       # rows of this task that were kept and still are
        fates, matches = [], []
        start = 0
        while start < len(idx):
            here = np.arange(start, min(start + sim.strip_rows(len(born) + sim.STRIP), len(idx)))
            start += len(here)
            rivals = np.concatenate([born, here])
            ((_, sims, hits),) = sim.products(vectors[place[here]], vectors[place[rivals]], threshold)
            i, j = np.nonzero(place[here][:, None] == place[rivals][None, :])
            sim.itself(sims, hits, i, j, threshold)
            standing = np.zeros(len(rivals), dtype=bool)
            standing[:len(born)] = True
            for r, row in enumerate(here):
                match, slot = None, None
                found = np.flatnonzero(hits[r] & standing)
                if len(found):
                    slot = found[0]
                    match = (idx[rivals[slot]], q[rivals[slot]], sims[r, slot])
                old = near.first(place[row], idx[row])
                if old is not None and (match is None or near.k[old] < match[0]):
                    match, slot = (near.k[old], near.q_k[old], near.similarity[old]), None
                matches.append(match)
                if match is not None and not q[row] > match[1]:
                    fates.append("loses")
                    continue
                fates.append("fresh" if match is None else "wins")
                standing[len(born) + r] = True
                if slot is not None:
                    standing[slot] = False
                elif match is not None:
                    near.dies(old, idx[row])
            born = rivals[standing]
        none = (None, None, None)
        k, q_k, cosine = zip(*(m or none for m in matches))
        return rows.select(["idx", "q", "gid", "salt", "comp", "pos"]).append_column(
            "k", pa.array(k, pa.int64())
        ).append_column("q_k", pa.array(q_k, pa.float64())).append_column(
            "similarity", pa.array(cosine, pa.float64())
        ).append_column("fate", pa.array(fates, pa.string()))

    return run


def _replay(
    rows: DataFrame, contested: DataFrame, near: DataFrame, threshold: float
) -> DataFrame:
    """The rule run row by row over the next undecided rows of each component.

    The caller has bounded the rows of a ``task``, which holds whole runs of components; ``near`` are
    the kept rows that their groups neighbour. What a task holds of different components is
    never similar, so they can be replayed together.
    """
    given = rows.join(_by_key(contested.select("gid", "unit")), "gid").select(
        "task", "idx", "q", "gid", "salt", "comp", "pos", "unit"
    )
    tasks = rows.select("gid", "task").distinct()
    kept = near.join(_by_key(tasks), "gid").select(F.col("task").alias("for"), "gid", "k", "q_k", "similarity", "dead")

    layout = (
        "idx bigint, q double, gid bigint, salt int, comp bigint, pos bigint, k bigint, q_k double, "
        "similarity double, fate string"
    )
    return given.groupBy("task").cogroup(kept.groupBy("for")).applyInArrow(_replay_task(threshold), layout)


def _next_rows(undecided: DataFrame, tail_rows: int) -> DataFrame:
    """Undecided rows with ``ahead``, whether they are among the next of their component, and ``task``.

    Components that start within an eighth of ``tail_rows`` positions share a task, so a task has
    at most 9/8 of ``tail_rows`` rows ahead.
    """
    first = undecided.groupBy("comp").agg(F.min("pos").alias("first"))
    return undecided.join(_by_key(first), "comp").withColumns({
        "ahead": F.col("pos") < F.col("first") + tail_rows,
        "task": F.floor(F.col("first") / max(1, tail_rows // 8)),
    }).drop("first")


def find_duplicates(
    df: DataFrame,
    threshold: float = 0.95,
    order: str = S.ROW_INDEX,
    vector: str = "image_embedding",
    quality: Column | None = None,
    tail_rows: int = TAIL_ROWS,
    block: int = sim.BLOCK_ROWS,
    cell_rows: int = sim.CELL_ROWS,
) -> DataFrame:
    """One row per rejected row: which kept row it lost to, their cosine and both qualities.

    ``order`` is a unique integer column that gives the input order.
    """
    spark = df.sparkSession
    quality = quality_score() if quality is None else quality
    items = df.select(
        F.col(order).cast("bigint").alias("idx"), quality.cast("double").alias("q"),
        F.col(vector).alias("vector"),
    )
    if threshold > 1:
        return spark.createDataFrame([], _PAIR_LAYOUT)
    contested, members = _prepare(items, "vector", threshold, block, cell_rows, tail_rows)
    # Tables that grow by a part each round.
    found = _Growing(spark, "pairs", _PAIR_LAYOUT)
    edges = _Growing(spark, "edges", "gid bigint, other bigint, similarity double")
    compared = _Growing(spark, "compared", "gid bigint")

    if threshold > 0:
        if not contested.filter("complete").isEmpty():
            found.add(_settle_complete(members.filter("complete"), contested.filter("complete")))
        contested, members = contested.filter("not complete"), members.filter("not complete")
    # The first row of a neighbourhood has nothing before it and is kept.
    state = _Tables(
        undecided=members.filter("idx <> lb").select("idx", "q", "gid", "salt", "comp", "pos"),
        groups=contested.select("gid", "parts", "lb"),
        kept=members.filter("idx = lb").select(
            F.col("idx").alias("k"), F.col("gid").alias("w"), F.col("q").alias("q_k"),
            F.lit(None).cast("bigint").alias("dead"), "comp",
        ),
    )

    def compare_new() -> None:
        """Pairs of active groups with groups that have their first kept row."""
        fresh = compared.add(
            state.kept.select(F.col("w").alias("gid")).distinct()
            .join(_by_key(compared.table()), "gid", "left_anti")
        )
        edges.add(sim.similar_pairs(
            _active(contested, state.undecided), _active(contested, fresh), threshold, block
        ))

    def settle(decided: DataFrame, undecided: DataFrame) -> None:
        found.add(_pairs_of(decided))
        state.undecided = undecided
        state.kept = write_table(_next_kept(state.kept, decided, undecided), "kept")

    while not state.undecided.isEmpty():
        compare_new()
        if tail_rows > 0:
            placed = write_table(_next_rows(state.undecided, tail_rows), "placed")
            ahead = placed.filter("ahead")
            near = _kept_near(edges.table(), state.kept).join(_by_key(ahead.select("gid")), "gid", "left_semi")
            replayed = write_table(_replay(ahead, contested, near, threshold), "replayed")
            settle(replayed, placed.filter("not ahead").drop("ahead", "task"))
            if state.undecided.isEmpty():
                break
            compare_new()
        state.groups = _next_groups(state, contested, threshold, block)
        decided = write_table(_decide(state, edges.table()), "decided")
        waiting = decided.filter("fate = 'waits'").select("idx", "q", "gid", "salt", "comp", "pos")
        settle(decided, waiting)
    return found.table()


def duplicate_pairs(df: DataFrame, found: DataFrame, order: str = S.ROW_INDEX) -> DataFrame:
    """The report of rejected samples, with sample ids in place of row numbers."""
    ids = df.select(F.col(order).alias("_row"), "sample_id")
    named = found
    for side in ("duplicate", "kept"):
        named = named.join(ids, F.col(f"{side}_idx") == F.col("_row")).withColumn(
            f"{side}_sample_id", F.col("sample_id")
        ).drop("_row", "sample_id")
    return named.select(*S.DUPLICATE_PAIR_SCHEMA.fieldNames())


def mark_duplicates(df: DataFrame, found: DataFrame, order: str = S.ROW_INDEX) -> DataFrame:
    """All rows, with the rejected ones marked."""
    hit = found.select(F.col("duplicate_idx").alias("_dup"))
    joined = df.join(hit, F.col(order) == F.col("_dup"), "left")
    out = F.col("_dup").isNotNull()
    columns = {
        "status": F.when(out, F.lit(S.REJECTED)).otherwise(F.col("status")),
        "reject_reason": F.when(out, F.lit(S.SEMANTIC_DUPLICATE)).otherwise(F.col("reject_reason")),
    }
    if S.REJECTED_BY in df.columns:
        columns[S.REJECTED_BY] = F.when(out, F.lit(S.DEDUP_LABEL)).otherwise(F.col(S.REJECTED_BY))
    return joined.withColumns(columns).drop("_dup")


def survivors(df: DataFrame, found: DataFrame, order: str = S.ROW_INDEX) -> DataFrame:
    return df.join(found, F.col(order) == F.col("duplicate_idx"), "left_anti")


def dedup_metrics(df: DataFrame, found: DataFrame) -> DataFrame:
    """``input_samples, duplicates_removed, output_samples``; zeros on empty input."""
    marks = df.select(F.lit(False).alias("removed")).unionByName(
        found.select(F.lit(True).alias("removed"))
    )
    total, removed = F.count_if(~F.col("removed")), F.count_if(F.col("removed"))
    return marks.agg(
        total.alias("input_samples"), removed.alias("duplicates_removed"),
        (total - removed).alias("output_samples"),
    )


class SemanticDedup:
    """The dataset step with its settings: ``process`` returns the survivors and the report."""

    label = S.DEDUP_LABEL

    def __init__(
        self,
        threshold: float = 0.95,
        model_name: str = "openai/clip-vit-base-patch32",
        batch_size: int = 32,
        **tuning,
    ):
        self.threshold, self.model_name, self.batch_size = threshold, model_name, batch_size
        self.tuning = tuning

    def process(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        found = find_duplicates(df, self.threshold, **self.tuning)
        return survivors(df, found), found
