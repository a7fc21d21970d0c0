"""Versions, merges and deletions of works: incremental semantics as joins and ordered folds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.sources.scratch import kept

STATES = ("ACTIVE", "DELETED")
ACCEPTED = ("INSERT", "APPLY_UPDATE")
REJECTED = ("RESTORE_REQUIRED", "CONFLICT", "STALE")


def date_order(old: Column, new: Column) -> Column:
    """NEWER, STALE or CONFLICT by date; a dated side beats an undated one, and equal or no dates conflict."""
    return (
        F.when(old.isNotNull() & new.isNotNull(), F.when(new > old, "NEWER").when(new < old, "STALE").otherwise("CONFLICT"))
        .when(new.isNotNull(), "NEWER")
        .when(old.isNotNull(), "STALE")
        .otherwise("CONFLICT")
    )


def version_outcome(old_checksum: Column, old_date: Column, new_checksum: Column, new_date: Column) -> Column:
    """IDENTICAL for the same checksum, else by date."""
    return F.when(old_checksum == new_checksum, "IDENTICAL").otherwise(date_order(old_date, new_date))


def publication_decisions(staging: DataFrame, target: DataFrame) -> DataFrame:
    """(work_id, source_activity_state, publication_decision) for each staged work; write it down before merging.

    In this order: unknown work INSERT; same checksum IDENTICAL; active over deleted RESTORE_REQUIRED; then by date,
    where a deletion of equal date is applied to an active work and other equal dates conflict.
    """
    new, old = F.col("s.lineage_source_updated_date"), F.col("t.lineage_source_updated_date")
    by_date = date_order(old, new)
    decision = (
        F.when(F.col("t.work_id").isNull(), "INSERT")
        .when(F.col("s.source_checksum_sha256") == F.col("t.source_checksum_sha256"), "IDENTICAL")
        .when((F.col("t.activity_state") == "DELETED") & (F.col("s.activity_state") == "ACTIVE"), "RESTORE_REQUIRED")
        .when((new == old) & (F.col("t.activity_state") == "ACTIVE") & (F.col("s.activity_state") == "DELETED"), "APPLY_UPDATE")
        .when(by_date == "NEWER", "APPLY_UPDATE")
        .otherwise(by_date)
    )
    joined = staging.alias("s").join(target.alias("t"), F.col("s.work_id") == F.col("t.work_id"), "left")
    return joined.select("s.work_id", F.col("s.activity_state").alias("source_activity_state"), decision.alias("publication_decision"))


def accepted_ids(decisions: DataFrame) -> DataFrame:
    return decisions.where(F.col("publication_decision").isin(*ACCEPTED)).select("work_id")


def relationship_scope(decisions: DataFrame) -> DataFrame:
    """Works whose relationships are replaced: accepted and active. A tombstone keeps what its work had."""
    return decisions.where(F.col("publication_decision").isin(*ACCEPTED) & (F.col("source_activity_state") == "ACTIVE")).select("work_id")


def rejected(decisions: DataFrame) -> DataFrame:
    return decisions.where(F.col("publication_decision").isin(*REJECTED)).select("work_id", "publication_decision")


def decision_alias(decisions: DataFrame) -> DataFrame:
    return decisions.select("work_id", F.col("publication_decision").alias("classification"))


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """df, or an error if a required column holds a NULL."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    missing = [c for c in columns if counts[c]]
    if missing:
        raise ValueError(f"NULL in required columns: {', '.join(missing)}")
    return df


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    if not df.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"repeated key {', '.join(keys)}")
    return df


def merge_works(target: DataFrame, staging: DataFrame, decisions: DataFrame, touched: tuple[str, ...] = ("run_id", "processed_at")) -> DataFrame:
    """The next version of target: IDENTICAL refreshes the touched columns, APPLY_UPDATE replaces a row, INSERT adds one, the rest stays."""
    source = staging.join(decisions.select("work_id", "publication_decision"), "work_id")
    joined = target.alias("t").join(source.alias("s"), F.col("t.work_id") == F.col("s.work_id"), "full")
    joined = joined.where(F.col("t.work_id").isNotNull() | (F.col("s.publication_decision") == "INSERT"))
    taken = F.coalesce(F.col("s.publication_decision").isin(*ACCEPTED), F.lit(False))
    fresh = F.coalesce(F.col("s.publication_decision") == "IDENTICAL", F.lit(False))
    return joined.select(*[F.when(taken | fresh if c in touched else taken, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns])


def replace_by_work(target: DataFrame, staging: DataFrame, scope: DataFrame) -> DataFrame:
    """Rows of works in scope are replaced by their staged rows."""
    return target.join(scope, "work_id", "left_anti").unionByName(staging.join(scope, "work_id", "left_semi").select(*target.columns))


def merge_counts(target: DataFrame, staging: DataFrame, decisions: DataFrame) -> DataFrame:
    """Decision counts beside what the merge did: one row (decision, decided, done)."""
    after = merge_works(target, staging, decisions).select("work_id", F.col("source_checksum_sha256").alias("after"), "run_id")
    rows = decisions.join(after, "work_id", "left").join(staging.select("work_id", F.col("source_checksum_sha256").alias("staged"), F.col("run_id").alias("staged_run")), "work_id")
    done = F.when(F.col("publication_decision").isin(*ACCEPTED), F.col("after") == F.col("staged")).when(F.col("publication_decision") == "IDENTICAL", F.col("run_id") == F.col("staged_run")).otherwise(F.col("after") != F.col("staged"))
    return rows.groupBy("publication_decision").agg(F.count("*").alias("decided"), F.count_if(done).alias("done"))


def deletion_outcome(state: Column, old_date: Column, deleted_date: Column) -> Column:
    """What a deletion does to a work; state is NULL for an unknown work."""
    return (
        F.when(state.isNull(), "UNKNOWN_WORK")
        .when(state == "DELETED", F.when(old_date.isNotNull() & (deleted_date < old_date), "STALE").otherwise("ALREADY_DELETED"))
        .when(old_date.isNull() | (deleted_date < old_date), "STALE")
        .otherwise("DELETED")
    )


def classify_deletions(works: DataFrame, ledger: DataFrame) -> DataFrame:
    joined = ledger.alias("d").join(works.alias("w"), F.col("d.work_id") == F.col("w.work_id"), "left")
    outcome = deletion_outcome(F.col("w.activity_state"), F.col("w.lineage_source_updated_date"), F.col("d.deleted_date"))
    return joined.select("d.work_id", "d.deleted_date", outcome.alias("outcome"))


def tombstone(works: DataFrame, deletions: DataFrame, asset: str, checksum: str, run_id: str) -> DataFrame:
    """Works with the deletions of outcome DELETED applied: payload stays, lineage becomes the deletion's."""
    gone = deletions.where("outcome = 'DELETED'").select("work_id", "deleted_date")
    joined = works.join(gone, "work_id", "left")
    hit = F.col("deleted_date").isNotNull()
    new = {
        "source_asset_id": F.lit(asset),
        "source_checksum_sha256": F.lit(checksum),
        "lineage_source_updated_date": F.col("deleted_date"),
        "run_id": F.lit(run_id),
        "activity_state": F.lit("DELETED"),
        "deleted_at": F.col("deleted_date").cast("timestamp"),
    }
    return joined.select(*[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in works.columns])


def dedupe_ledger(ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row for each (work, date) with its number of repeats, and the works of more than one date, which reject their ledger.

    Where the rows name their asset, each ledger is judged apart: two ledgers may give a work two dates.
    """
    keys = ["asset", "work_id"] if "asset" in ledger.columns else ["work_id"]
    groups = ledger.groupBy(*keys).agg(F.min("deleted_date").alias("deleted_date"), F.countDistinct("deleted_date").alias("dates"), F.count("*").alias("rows"))
    return groups.where("dates <= 1").select(*keys, "deleted_date", (F.col("rows") - 1).alias("duplicates")), groups.where("dates > 1").select(*keys, "dates")


def update_barriers(barriers: DataFrame, unknown: DataFrame) -> DataFrame:
    """The latest deletion date of each work that was never seen."""
    return barriers.select("work_id", "deleted_date").unionByName(unknown.select("work_id", "deleted_date")).groupBy("work_id").agg(F.max("deleted_date").alias("deleted_date"))


def barrier_violations(works: DataFrame, barriers: DataFrame) -> DataFrame:
    """Active works with a barrier, and deleted ones without."""
    joined = works.select("work_id", "activity_state").join(barriers.select("work_id", "deleted_date"), "work_id", "left")
    bad = ((F.col("activity_state") == "ACTIVE") & F.col("deleted_date").isNotNull()) | ((F.col("activity_state") == "DELETED") & F.col("deleted_date").isNull())
    return joined.where(bad).select("work_id", "activity_state")


STATE = "struct<state:string,checksum:string,lineage_date:date,work_date:date,barrier:date,seq:bigint,pos:bigint>"
SEEN = "array<struct<seq:bigint,pos:bigint,kind:string,outcome:string,aside:boolean>>"
FOLD = f"struct<now:{STATE},side:{STATE},side_seq:bigint,outcomes:{SEEN}>"
OBSERVED = "array<struct<seq:bigint,pos:bigint,kind:string,checksum:string,lineage_date:date,work_date:date,aside:boolean>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body over a value that is written, and evaluated, once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _outcome(s: Column, o: Column) -> Column:
    blocked_by_barrier = o["lineage_date"].isNull() | (o["lineage_date"] <= s["barrier"])
    blocked_by_tombstone = F.coalesce(o["lineage_date"] <= s["lineage_date"], F.lit(False))
    by_version = version_outcome(s["checksum"], F.coalesce(s["lineage_date"], s["work_date"]), o["checksum"], F.coalesce(o["lineage_date"], o["work_date"]))
    work = (
        F.when(s["state"].isNull(), F.when(s["barrier"].isNull(), "INSERTED").when(blocked_by_barrier, "BLOCKED").otherwise("RESTORE_REQUIRED"))
        .when(s["state"] == "DELETED", F.when(blocked_by_tombstone, "BLOCKED").otherwise("RESTORE_REQUIRED"))
        .otherwise(let(by_version, lambda v: F.when(v == "NEWER", "REPLACED").otherwise(v)))
    )
    return F.when(o["kind"] == "work", work).otherwise(deletion_outcome(s["state"], s["lineage_date"], o["lineage_date"]))


def _after(s: Column, o: Column, outcome: Column) -> Column:
    take, gone, unknown = outcome.isin("INSERTED", "REPLACED"), outcome == "DELETED", outcome == "UNKNOWN_WORK"
    pick = lambda new, old: F.when(take | gone, new).otherwise(old)
    return F.struct(
        F.when(take, "ACTIVE").when(gone, "DELETED").otherwise(s["state"]).alias("state"),
        pick(o["checksum"], s["checksum"]).alias("checksum"),
        pick(o["lineage_date"], s["lineage_date"]).alias("lineage_date"),
        F.when(take, o["work_date"]).otherwise(s["work_date"]).alias("work_date"),
        F.when(gone, o["lineage_date"]).when(unknown, F.greatest(s["barrier"], o["lineage_date"])).otherwise(s["barrier"]).alias("barrier"),
        F.when(take, o["seq"]).otherwise(s["seq"]).alias("seq"),
        F.when(take, o["pos"]).otherwise(s["pos"]).alias("pos"),
    ).cast(STATE)


def _step(a: Column, o: Column) -> Column:
    """One observation. That of an asset left aside is judged, and tells on the rest of its asset, but leaves no state behind."""
    base = F.when(o["aside"] & (a["side_seq"] == o["seq"]), a["side"]).otherwise(a["now"])

    def moved(new: Column, outcome: Column) -> Column:
        told = F.struct(o["seq"].alias("seq"), o["pos"].alias("pos"), o["kind"].alias("kind"), outcome.alias("outcome"), o["aside"].alias("aside"))
        now, side = F.when(o["aside"], a["now"]).otherwise(new), F.when(o["aside"], new).otherwise(a["side"])
        return F.struct(now.alias("now"), side.alias("side"), F.when(o["aside"], o["seq"]).otherwise(a["side_seq"]).alias("side_seq"), F.array_append(a["outcomes"], told).alias("outcomes")).cast(FOLD)

    return let(base, lambda s: let(_outcome(s, o), lambda outcome: let(_after(s, o, outcome), lambda new: moved(new, outcome))))


def _fold(observations: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """fold_observations over rows of which some are aside; outcomes tell which."""
    fields = ("seq", "pos", "kind", "checksum", "lineage_date", "work_date", "aside")
    rows = observations.select("work_id", F.struct(F.col("seq").cast("long").alias("seq"), F.col("pos").cast("long").alias("pos"), *fields[2:]).alias("o"))
    grouped = rows.groupBy("work_id").agg(F.sort_array(F.collect_list("o")).cast(OBSERVED).alias("os"))
    nothing = F.lit(None).cast(STATE)
    empty = F.struct(*[F.lit(None).alias(c) for c in ("state", "checksum", "lineage_date", "work_date", "barrier", "seq", "pos")]).cast(STATE)
    if state is not None:
        start = state.select("work_id", F.struct("state", "checksum", "lineage_date", "work_date", "barrier", "seq", "pos").cast(STATE).alias("s"))
        grouped = grouped.join(start, "work_id", "full").select("work_id", F.coalesce("os", F.array().cast(OBSERVED)).alias("os"), F.coalesce("s", empty).alias("s"))
    else:
        grouped = grouped.select("work_id", "os", empty.alias("s"))
    first = F.struct(F.col("s").alias("now"), nothing.alias("side"), F.lit(None).alias("side_seq"), F.array().alias("outcomes")).cast(FOLD)
    return grouped.select("work_id", F.aggregate("os", first, _step).alias("f")).select("work_id", "f.now.*", "f.outcomes")


def _settled(folded: DataFrame) -> DataFrame:
    """A fold without what was aside: works that only such assets touch go."""
    seen = F.transform(F.filter("outcomes", lambda x: ~x["aside"]), lambda x: x.dropFields("aside"))
    return folded.withColumn("outcomes", seen).where("size(outcomes) > 0 OR state IS NOT NULL OR barrier IS NOT NULL")


def fold_observations(observations: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Apply observations to works in order of (seq, pos): (work_id, state, checksum, lineage_date, work_date, barrier, seq, pos, outcomes).

    observations: (work_id, seq, pos, kind, checksum, lineage_date, work_date), kind being work or deletion (its date in
    lineage_date). Outcomes of a work: INSERTED, REPLACED, IDENTICAL, STALE, BLOCKED (stale behind a tombstone or
    barrier: nothing is stored and entities stay untouched), CONFLICT and RESTORE_REQUIRED (these two abort their asset;
    here they change nothing). Of a deletion: DELETED, ALREADY_DELETED, STALE, UNKNOWN_WORK. seq and pos name the last
    accepted observation. A work has few observations, so its ordered list is small. An earlier result is the start.
    """
    return _settled(_fold(observations.withColumn("aside", F.lit(False)), state))


def outcomes_of(folded: DataFrame) -> DataFrame:
    return folded.select("work_id", F.explode("outcomes").alias("o")).select("work_id", "o.seq", "o.pos", "o.kind", "o.outcome")


ABORTS = ("CONFLICT", "RESTORE_REQUIRED")
FEEDS = ("INSERTED", "REPLACED", "IDENTICAL", "STALE")


class AssetFold:
    """A fold of works that is kept up while it is found out which assets abort.

    An asset counts as a whole: one that aborts must not influence later ones. Whether it aborts depends only on earlier
    assets that count. So all assets are judged over a guess of those that are left out (first none), the judgement
    is the next guess, and only works that changed assets touch are folded again; where nothing changes, the
    guess is the one right answer. The n-th asset of a chain of dependent ones is right after n rounds, all independent ones are at once.
    Assets left out stay in the fold aside: they are judged and leave nothing behind. Results are kept by `keep`; nothing
    of a round reaches the driver but whether it changed anything.
    """

    def __init__(self, observations: DataFrame, state: DataFrame | None = None, keep: Callable[[DataFrame], DataFrame] = kept):
        self.observations, self.state, self.keep, self.out, self.rounds = observations, state, keep, None, 1
        self.folded = keep(_fold(observations.withColumn("aside", F.lit(False)), state))

    def aborting(self) -> DataFrame:
        """(seq) of assets that abort over the present guess."""
        aborts = F.filter("outcomes", lambda x: x["outcome"].isin(*ABORTS))
        return self.folded.select(F.explode(F.transform(aborts, lambda x: x["seq"])).alias("seq")).distinct()

    def fed(self) -> DataFrame:
        """(work_id, seq, pos, aside) of observations that feed shared entities: all works but blocked and aborting ones."""
        feeds = F.array_distinct(F.filter("outcomes", lambda x: (x["kind"] == "work") & x["outcome"].isin(*FEEDS)))
        return self.folded.select("work_id", F.explode(feeds).alias("o")).select("work_id", "o.seq", "o.pos", "o.aside")

    def guess(self, out: DataFrame) -> bool:
        """Leave these assets (seq) out instead; False if they are the ones that are left out already."""
        out = self.keep(out)
        before = out.limit(0) if self.out is None else self.out
        changed = self.keep(out.join(before, "seq", "left_anti").unionByName(before.join(out, "seq", "left_anti")))
        self.out = out
        if changed.isEmpty():
            return False
        touched = self.keep(self.observations.join(changed, "seq", "left_semi").select("work_id").distinct())
        again = self.observations.join(touched, "work_id", "left_semi").join(out.withColumn("aside", F.lit(True)), "seq", "left").withColumn("aside", F.coalesce("aside", F.lit(False)))
        start = self.state.join(touched, "work_id", "left_semi") if self.state is not None else None
        self.folded = self.keep(self.folded.join(touched, "work_id", "left_anti").unionByName(_fold(again, start)))
        self.rounds += 1
        return True

    def result(self) -> tuple[DataFrame, list[int]]:
        """The fold and the numbers of the assets left out."""
        return _settled(self.folded), sorted(r["seq"] for r in self.out.collect())


def fold_assets(observations: DataFrame, state: DataFrame | None = None, keep: Callable[[DataFrame], DataFrame] = kept) -> tuple[DataFrame, list[int]]:
    """fold_observations with whole assets (seq) left out if any of their records aborts; returns the fold and the assets left out."""
    fold = AssetFold(observations, state, keep)
    while fold.guess(fold.aborting()):
        pass
    return fold.result()


def enrichment_rows(observations: DataFrame, folded: DataFrame) -> DataFrame:
    """Observations that feed shared entities: all works but blocked and aborting ones."""
    fed = outcomes_of(folded).where((F.col("kind") == "work") & F.col("outcome").isin(*FEEDS))
    return observations.join(fed.select("work_id", "seq", "pos"), ["work_id", "seq", "pos"], "left_semi")


def winning_relationships(relationship: DataFrame, folded: DataFrame) -> DataFrame:
    """Rows of (work_id, seq, pos, ...) that belong to each work's last accepted observation."""
    return relationship.join(folded.select("work_id", "seq", "pos"), ["work_id", "seq", "pos"], "left_semi")


def latest_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of each key in the given order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")
