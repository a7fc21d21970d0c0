"""Decisions, merges and folds against a plain sequential model."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from folioforge.operators import entities, profiling, publication, release, versions
from folioforge.streaming import ingest

DAY = date(2024, 1, 1)


def test_truth_table_of_decisions(spark):
    d0, d1 = DAY, DAY + timedelta(1)
    cases = [  # target (state, checksum, date) or None, source, decision
        (None, ("ACTIVE", "a", d0), "INSERT"),
        (("DELETED", "a", d1), ("ACTIVE", "a", d0), "IDENTICAL"),
        (("DELETED", "a", d0), ("ACTIVE", "b", d1), "RESTORE_REQUIRED"),
        (("ACTIVE", "a", d1), ("ACTIVE", "b", d0), "STALE"),
        (("ACTIVE", "a", d1), ("ACTIVE", "b", None), "STALE"),
        (("ACTIVE", "a", d0), ("DELETED", "b", d0), "APPLY_UPDATE"),
        (("ACTIVE", "a", d0), ("ACTIVE", "b", d0), "CONFLICT"),
        (("ACTIVE", "a", None), ("ACTIVE", "b", d0), "APPLY_UPDATE"),
        (("ACTIVE", "a", d0), ("ACTIVE", "b", d1), "APPLY_UPDATE"),
        (("ACTIVE", "a", None), ("ACTIVE", "b", None), "CONFLICT"),
    ]
    schema = "work_id string, activity_state string, source_checksum_sha256 string, lineage_source_updated_date date, run_id string"
    target = spark.createDataFrame([(f"W{i}", *t, "r1") for i, (t, _, _) in enumerate(cases) if t], schema)
    staging = spark.createDataFrame([(f"W{i}", *s, "r2") for i, (_, s, _) in enumerate(cases)], schema)
    decisions = versions.publication_decisions(staging, target)
    assert {r["work_id"]: r["publication_decision"] for r in decisions.collect()} == {f"W{i}": d for i, (_, _, d) in enumerate(cases)}
    merged = {r["work_id"]: r for r in versions.merge_works(target, staging, decisions).collect()}
    for i, (t, s, d) in enumerate(cases):
        r, taken = merged[f"W{i}"], d in ("INSERT", "APPLY_UPDATE")
        assert (r["activity_state"], r["source_checksum_sha256"], r["lineage_source_updated_date"]) == (s if taken else t)
        assert r["run_id"] == ("r2" if taken or d == "IDENTICAL" else "r1")


def model(observations):
    """One work at a time, in order: what the fold must do."""
    state, outcomes = {}, {}
    for work, seq, pos, kind, checksum, lineage, own in sorted(observations, key=lambda o: (o[1], o[2])):
        s = state.setdefault(work, {"state": None, "checksum": None, "lineage": None, "own": None, "barrier": None})
        if kind == "deletion":
            if s["state"] is None:
                out = "UNKNOWN_WORK"
                s["barrier"] = max(x for x in (s["barrier"], lineage) if x)
            elif s["state"] == "DELETED":
                out = "STALE" if s["lineage"] and lineage < s["lineage"] else "ALREADY_DELETED"
            elif s["lineage"] is None or lineage < s["lineage"]:
                out = "STALE"
            else:
                out = "DELETED"
                s.update(state="DELETED", checksum=checksum, lineage=lineage, barrier=lineage)
        elif s["state"] is None:
            out = "INSERTED" if s["barrier"] is None else "BLOCKED" if lineage is None or lineage <= s["barrier"] else "RESTORE_REQUIRED"
        elif s["state"] == "DELETED":
            out = "BLOCKED" if lineage and s["lineage"] and lineage <= s["lineage"] else "RESTORE_REQUIRED"
        else:
            old, new = s["lineage"] or s["own"], lineage or own
            if checksum == s["checksum"]:
                out = "IDENTICAL"
            elif old and new:
                out = "REPLACED" if new > old else "STALE" if new < old else "CONFLICT"
            else:
                out = "REPLACED" if new else "STALE" if old else "CONFLICT"
        if out in ("INSERTED", "REPLACED"):
            s.update(state="ACTIVE", checksum=checksum, lineage=lineage, own=own)
        outcomes[work, seq, pos] = out
    return {w: (s["state"], s["checksum"], s["lineage"], s["barrier"]) for w, s in state.items()}, outcomes


def observations(seed, works=40):
    rng, out = random.Random(seed), []
    for w in range(works):
        for k in range(rng.randint(1, 7)):
            when = rng.choice([None, *[DAY + timedelta(rng.randint(0, 4)) for _ in range(4)]])
            kind = rng.choice(["work", "work", "deletion"])
            out.append((f"W{w}", rng.randint(1, 5), k, kind, rng.choice("abcd"), when or (DAY if kind == "deletion" else None), rng.choice([None, DAY])))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fold_follows_the_model(spark, seed):
    seen = observations(seed)
    df = spark.createDataFrame(seen, "work_id string, seq long, pos long, kind string, checksum string, lineage_date date, work_date date").repartition(seed + 1)
    folded = versions.fold_observations(df)
    state, outcomes = model(seen)
    assert {r["work_id"]: (r["state"], r["checksum"], r["lineage_date"], r["barrier"]) for r in folded.collect()} == state
    assert {(r["work_id"], r["seq"], r["pos"]): r["outcome"] for r in versions.outcomes_of(folded).collect()} == outcomes


def test_assets_fold_whole_or_not(spark):
    rows = [("W1", 1, 0, "work", "a", DAY, None), ("W1", 2, 0, "work", "b", DAY, None), ("W2", 2, 1, "work", "b", DAY, None), ("W2", 3, 0, "work", "c", DAY, None)]
    df = spark.createDataFrame(rows, "work_id string, seq long, pos long, kind string, checksum string, lineage_date date, work_date date")
    folded, dropped = versions.fold_assets(df)
    assert dropped == [2] and {r["work_id"]: r["checksum"] for r in folded.collect()} == {"W1": "a", "W2": "c"}


def test_batch_equals_stream(spark, tmp_path):
    seen = [o for o in observations(9) if o[3] == "work" and o[5]]
    df = spark.createDataFrame(seen, ingest.OBSERVATION)
    folder = str(tmp_path / "in")
    state = ingest.StateTable(spark, str(tmp_path / "state"))
    for seq in (1, 2, 3, 4, 5):
        df.where(f"seq = {seq}").coalesce(1).write.mode("append").json(folder)
        ingest.run_once(ingest.file_stream(spark, folder), state, str(tmp_path / "checkpoint"))
    whole, _ = versions.fold_assets(df)
    pick = lambda x: sorted(map(str, x.select("work_id", "state", "checksum", "lineage_date").collect()))
    assert pick(state.read()) == pick(whole)
    before = pick(state.read())
    state.apply(df, 0)  # a replayed batch is a no-op
    assert pick(state.read()) == before


def test_reconcile_entities(spark):
    rows = [("A1", "Ann", None, DAY, 1, 0), ("A1", None, "0001", DAY, 1, 5), ("A1", "Anne", "0001", DAY + timedelta(2), 2, 0), ("A1", "Old", "0001", DAY, 3, 0), ("A2", "x", None, None, 1, 1), ("A2", "y", None, None, 1, 2)]
    df = spark.createDataFrame(rows, "author_id string, display_name string, orcid string, date date, seq long, pos long")
    out = {r["author_id"]: (r["display_name"], r["orcid"], r["conflicts"]) for r in entities.reconcile_entities(df, "author_id", ["display_name", "orcid"]).collect()}
    assert out == {"A1": ("Anne", "0001", 0), "A2": ("x", None, 1)}


def test_stage_activate_restore(spark, tmp_path):
    root, df = str(tmp_path / "mart"), spark.createDataFrame([(1, "a")], "k int, v string")
    publication.activate(spark, root, "v1", publication.stage(df, root, "v1"))
    assert publication.stage(df, root, "v1") == publication.active_version(spark, root)["fingerprint"]
    with pytest.raises(ValueError):
        publication.stage(df.unionAll(df), root, "v1")
    publication.activate(spark, root, "v2", publication.stage(df.unionAll(df), root, "v2"))
    assert publication.read_active(spark, root).count() == 2
    publication.restore(spark, root)
    assert publication.read_active(spark, root).count() == 1


def test_aborting_assets_in_rounds(spark):
    """The assets left out are those that dropping the first aborting one, again and again, leaves out."""
    rng = random.Random(5)
    kinds = ["work"] * 4 + ["deletion"]
    rows = []
    for i in range(160):
        kind, day = rng.choice(kinds), rng.choice([None, 1, 2, 3, 4])
        rows.append((f"W{rng.randrange(25)}", rng.randrange(14), i, kind, f"c{rng.randrange(4)}", date(2024, 1, day or 1) if day or kind == "deletion" else None, None))
    seen = spark.createDataFrame(rows, "work_id string, seq long, pos long, kind string, checksum string, lineage_date date, work_date date")
    dropped = []
    while True:
        folded = versions.fold_observations(seen.where(~F.col("seq").isin(dropped)) if dropped else seen)
        first = versions.outcomes_of(folded).where("outcome IN ('CONFLICT', 'RESTORE_REQUIRED')").agg(F.min("seq")).first()[0]
        if first is None:
            break
        dropped.append(first)
    got, out = versions.fold_assets(seen)
    assert out == sorted(dropped) and 0 < len(dropped) < 14
    plain = lambda df: sorted(map(str, df.select("work_id", "state", "checksum", "lineage_date", "barrier", "seq", "pos").collect()))
    assert plain(got) == plain(folded)


def test_an_entity_clash_aborts_its_asset(spark):
    seen = spark.createDataFrame([(f"W{i}", i, 0, "work", f"c{i}", None, None) for i in (1, 2, 3)], "work_id string, seq long, pos long, kind string, checksum string, lineage_date date, work_date date")
    told = spark.createDataFrame([("A1", "Ann", None, "W1", 1, 0), ("A1", "Bob", None, "W2", 2, 0), ("A2", "Cid", None, "W2", 2, 0), ("A1", "Ann", None, "W3", 3, 0)], "author_id string, display_name string, date date, work_id string, seq long, pos long")
    built, dropped = release.replay(seen, {}, {"authors": (told, ["display_name"])})
    assert dropped == [2]
    assert sorted((r["author_id"], r["display_name"]) for r in built["authors"].collect()) == [("A1", "Ann")]
    assert sorted(r["work_id"] for r in built["works"].collect()) == ["W1", "W3"]


def test_decision_order_and_line_counts(spark, tmp_path):
    rows = [(f"a{i}", i % 3) for i in range(20)]
    df = spark.createDataFrame(rows, "asset_id string, processed_at int")
    got = {r["asset_id"]: r["seq"] for r in publication.frozen_decision_order(df).collect()}
    assert got == {a: i for i, (a, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])), 1)}
    (tmp_path / "a.txt").write_text("x\n\n y\r\nz")
    (tmp_path / "b.txt").write_text("x\n")
    counts = {r["asset"].rpartition("/")[2]: (r["records"], r["blank"], r["unterminated"]) for r in profiling.line_counts(spark, str(tmp_path)).collect()}
    assert counts == {"a.txt": (3, 1, True), "b.txt": (1, 0, False)}


OBSERVED = "work_id string, seq long, pos long, kind string, checksum string, lineage_date date, work_date date"


def test_an_abort_that_frees_another_asset(spark):
    """Asset 2 aborts; without it asset 3 aborts, and without that asset 4 does not."""
    day = lambda n: DAY + timedelta(n)
    rows = [("W0", 1, 0, "work", "a", day(0), None), ("W1", 1, 1, "work", "a", day(0), None), ("W0", 2, 0, "work", "b", day(0), None), ("W1", 2, 1, "work", "b", day(2), None)]
    rows += [("W1", 3, 0, "work", "c", day(0), None), ("W2", 3, 1, "work", "c", day(0), None), ("W2", 4, 0, "work", "d", day(0), None)]
    folded, dropped = versions.fold_assets(spark.createDataFrame(rows, OBSERVED))
    assert dropped == [2, 3] and {r["work_id"]: r["checksum"] for r in folded.collect()} == {"W0": "a", "W1": "a", "W2": "d"}


def test_an_asset_that_clashes_with_itself(spark):
    rows = [("W1", 1, 0, "work", "a", DAY, None), ("W1", 1, 1, "work", "b", DAY, None), ("W1", 2, 0, "work", "c", DAY, None), ("W9", 1, 2, "work", "x", DAY, None)]
    folded, dropped = versions.fold_assets(spark.createDataFrame(rows, OBSERVED))
    assert dropped == [1] and [(r["work_id"], r["checksum"], [o["outcome"] for o in r["outcomes"]]) for r in folded.collect()] == [("W1", "c", ["INSERTED"])]


def test_a_thousand_clashing_assets_take_two_rounds(spark):
    rows = [(f"W{i}", 1, i, "work", "a", DAY, None) for i in range(1500)] + [(f"W{i}", 2 + i, 0, "work", "b" if i < 1000 else "a", DAY, None) for i in range(1500)]
    fold = versions.AssetFold(spark.createDataFrame(rows, OBSERVED))
    while fold.guess(fold.aborting()):
        pass
    folded, dropped = fold.result()
    assert dropped == list(range(2, 1002)) and fold.rounds == 2 and folded.where("checksum = 'a'").count() == 1500


def entity_model(told, fields, start=None, aside=()):
    """One entity's ordered fold: (fields, date, seq, pos, conflicting assets)."""
    now, side, side_seq, last, clashes = start, None, None, None, []
    for seq, pos, day, *values in sorted(told, key=lambda x: x[:2]):
        base = side if seq in aside and seq == side_seq else now
        new = base
        if base is None:
            new = (tuple(values), day, seq, pos)
        elif last != (seq, values):
            old, old_day = base[0], base[1]
            if any(a is not None and b is not None and a != b for a, b in zip(old, values, strict=True)):
                if day and (old_day is None or day > old_day):
                    new = (tuple(values), day, seq, pos)
                elif day == old_day:
                    clashes.append(seq)
            elif any(a is None and b is not None for a, b in zip(old, values, strict=True)):
                new = (tuple(b if a is None else a for a, b in zip(old, values, strict=True)), day, seq, pos)
        last = (seq, values)
        if seq in aside:
            side, side_seq = new, seq
        else:
            now = new
    return now, clashes


@pytest.mark.parametrize("seed", [1, 2])
def test_large_entities_fold_in_blocks(spark, seed):
    """Blocks of seven descriptions leave what one ordered fold leaves, over stored rows and with assets aside."""
    rng, rows = random.Random(seed), []
    for e, n in (("A", 300), ("B", 41), ("C", 7), ("D", 1)):
        for _ in range(n):
            seq = rng.randrange(60)
            rows.append((e, seq, len(rows), None if seq % 9 == 0 else DAY + timedelta(seq * 7 % 40), rng.choice([None, "x", "x", "y"]), rng.choice([None, None, "1", "2"]), seq % 5 == 0))
    df = spark.createDataFrame(rows, "k string, seq long, pos long, date date, name string, kind string, aside boolean")
    stored = spark.createDataFrame([("A", 99, 5, DAY, "z", None), ("E", 1, 1, None, None, "q")], "k string, seq long, pos long, date date, name string, kind string")
    for frame, aside, start in ((df.drop("aside"), set(), None), (df, {s for s in range(60) if s % 5 == 0}, stored)):
        got = {r["k"]: r for r in entities.reconcile_entities(frame, "k", ["name", "kind"], start, block=7).collect()}
        for e in "ABCD":
            first = (("z", None), DAY, 99, 5) if start is not None and e == "A" else None
            now, clashes = entity_model([r[1:6] for r in rows if r[0] == e], 2, first, aside)
            if now is None:
                assert e not in got or not got[e]["known"]
                continue
            r = got[e]
            assert ((r["name"], r["kind"]), r["date"], r["seq"], r["pos"]) == now and r["conflicts"] == len(clashes) and set(r["conflict_seqs"]) == set(clashes), e
        assert start is None or got["E"]["kind"] == "q"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_replay_equals_assets_in_order(spark, seed):
    """Assets one after the other, each kept or left out as a whole by its works and its entities."""
    rng, seen, told = random.Random(seed), [], []
    for i in range(70):
        seq, when = 1 + i // 5, rng.choice([None, *[DAY + timedelta(rng.randint(0, 3)) for _ in range(5)]])
        seen.append((f"W{rng.randrange(25)}", seq, i, "work", rng.choice("ab"), when, None))
        if rng.random() < 0.6:
            told.append((f"A{rng.randrange(9)}", rng.choice("xxxy"), when, seen[-1][0], seq, i))
    kept_, lost = [], []
    for seq in range(1, 15):
        trial = [o for o in seen if o[1] in kept_ or o[1] == seq]
        _, outcomes = model(trial)
        bad = any(out in versions.ABORTS for (_, s, _), out in outcomes.items() if s == seq)
        fed = {k for k, out in outcomes.items() if out in versions.FEEDS}
        for a in {t[0] for t in told}:
            lines = [(t[4], t[5], t[2], t[1]) for t in told if t[0] == a and (t[3], t[4], t[5]) in fed]
            bad |= seq in entity_model(lines, 1)[1]
        (lost if bad else kept_).append(seq)
    final, outcomes = model([o for o in seen if o[1] in kept_])
    fed = {k for k, out in outcomes.items() if out in versions.FEEDS}
    people = {a: entity_model([(t[4], t[5], t[2], t[1]) for t in told if t[0] == a and (t[3], t[4], t[5]) in fed], 1)[0] for a in {t[0] for t in told}}
    built, dropped = release.replay(spark.createDataFrame(seen, OBSERVED), {}, {"authors": (spark.createDataFrame(told, "author_id string, display_name string, date date, work_id string, seq long, pos long"), ["display_name"])})
    assert dropped == lost and 0 < len(lost) < 14
    assert {r["work_id"]: (r["state"], r["checksum"], r["lineage_date"], None) for r in built["works"].collect()} == {w: s for w, s in final.items() if s[0]}
    assert {r["author_id"]: r["display_name"] for r in built["authors"].collect()} == {a: p[0][0] for a, p in people.items() if p}


def test_replay_from_a_parent_equals_one_from_nothing(spark):
    rng, seen, told = random.Random(8), [], []
    for i in range(80):
        seq, when, kind = 1 + i // 8, rng.choice([None, *[DAY + timedelta(rng.randint(0, 3)) for _ in range(5)]]), rng.choice(["work"] * 5 + ["deletion"])
        seen.append((f"W{rng.randrange(22)}", seq, i, kind, rng.choice("ab"), when or (DAY if kind == "deletion" else None), None))
        if kind == "work":
            told.append((f"A{rng.randrange(9)}", rng.choice(["x", "x", "x", "y"]), when, seen[-1][0], seq, i))
    works, people = spark.createDataFrame(seen, OBSERVED), spark.createDataFrame(told, "author_id string, display_name string, date date, work_id string, seq long, pos long")
    topics = works.where("kind = 'work'").select("work_id", "seq", "pos", F.concat(F.lit("T"), "pos").alias("topic_id"))

    def run(where, parent=None):
        return release.replay(works.where(where), {"work_topics": topics.where(where)}, {"authors": (people.where(where), ["display_name"])}, parent)

    whole, lost = run("true")
    first, out = run("seq <= 4")
    then, more = run("seq > 4", first)
    assert out + more == lost and lost
    facts = lambda tables: sorted(map(str, release.release_manifest({n: df.select(*sorted(df.columns)) for n, df in tables.items()}).collect()))
    assert set(then) == set(whole) and facts(then) == facts(whole)
    assert release.parent_mismatches(first["outcomes"], then["outcomes"]).isEmpty()


def test_a_ledger_of_one_date_is_profiled_in_blocks(spark):
    rng = random.Random(4)
    rows = [(rng.choice([DAY, DAY, DAY + timedelta(1), None]), pos, rng.choice([f"W{rng.randrange(50)}", f"W{rng.randrange(50)}", "bad", None])) for pos in range(90)]
    want = {}
    for day in {r[0] for r in rows}:
        ids = [r[2] for r in rows if r[0] == day]
        numbers = [int(i[1:]) if i and i != "bad" else None for i in ids]
        low = sum(1 for a, b in zip(numbers, numbers[1:], strict=False) if a is not None and b is not None and b < a)
        want[day] = (len(ids), numbers.count(None), low)
    ledger = spark.createDataFrame(rows, "deleted_date date, pos long, work_id string").repartition(3)
    for block in (4, 1000):
        assert {r["deleted_date"]: (r["rows"], r["bad_shape"], r["out_of_order"]) for r in profiling.ledger_profile(ledger, block).collect()} == want
