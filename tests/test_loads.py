"""Loads as wholes: files read once, commits that survive a stop at any step, lost folders."""

from __future__ import annotations

import json
import re
import shutil

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from starlode.__main__ import main
from starlode.operators import folders, without_stamp, write_table
from starlode.operators.load import open_table, recover, table_location
from starlode.operators.loads import Load, Overtaken, append_load, ledger, replace_loads
from starlode.plans import Lakehouse, jobs, run_bronze, run_gold, run_gold_delta, run_silver, run_silver_delta
from starlode.sources import OTHER, all_fields, explode_records, page_gaps, page_of_envelope, page_of_file, read_envelopes
from starlode.streaming import landing_stream, run_bronze_new_files
from tests.landed import when, write_pages



class Stop(Exception):
    """Stands for a driver that dies."""


def user_types(*rows):
    return [{"userTypeId": i, "name": n, "updatedAt": w} for i, n, w in rows]


@pytest.fixture
def made(lake, tmp_path):
    return Lakehouse(lake.bronze, lake.silver, lake.gold, location=str(tmp_path / "lake"))


def names(spark, made, layer="bronze"):
    rows = open_table(spark, made.table(layer, "user_types")).select("userTypeId", "name").collect()
    return sorted((int(r[0]), r[1]) for r in rows)


# --- files are read once ---------------------------------------------------------------


def test_every_file_is_read_once(spark, made, tmp_path, monkeypatch):
    read = []
    whole = jobs.read_envelopes

    def watched(*args, **kwargs):
        envelopes = whole(*args, **kwargs)
        read.append({f.rpartition("/")[2] for f in envelopes.inputFiles()})
        return envelopes

    monkeypatch.setattr(jobs, "read_envelopes", watched)
    landing = tmp_path / "landing"
    load = lambda **kw: run_bronze(spark, made, "user_types", str(landing), file_per_envelope=True, **kw)
    write_pages(landing, user_types((1, "a", when(2)), (2, "b", None)))
    assert (load().mode, load().mode) == ("FULL", None)
    write_pages(landing, user_types((3, "c", when(3)), (4, "old", when(1)), (5, "d", None)), first=2)
    report = load()
    assert (report.mode, report.rows, report.undated, report.files, report.missing_pages) == ("INCREMENTAL", 2, 1, 2, 0)
    write_pages(landing, user_types((6, "e", when(4))), first=9)
    report = load()
    assert (report.rows, report.missing_pages) == (1, 5)
    assert load().mode is None
    assert names(spark, made) == [(1, "a"), (2, "b"), (3, "c"), (5, "d"), (6, "e")]
    assert read == [{"page_001.json"}, {"page_002.json", "page_003.json"}, {"page_009.json"}]
    # a file that is written anew is another file
    write_pages(landing, user_types((7, "written anew", when(5))), first=9)
    assert load().rows == 1
    # all of it once more
    assert load(force_full=True).rows == 6 and load().mode is None


def test_odd_file_names_and_partition_folders(spark, made, tmp_path):
    landing = tmp_path / "landing"
    for n, name in enumerate(("a b.json", "a+b%20[1].json", "é{x}.json"), 1):
        folder = landing / f"day={n}"
        folder.mkdir(parents=True)
        page = {"data": user_types((n, "x", when(n))), "meta": {}}
        (folder / name).write_text(json.dumps(page))
        assert run_bronze(spark, made, "user_types", str(landing)).rows == 1
    assert run_bronze(spark, made, "user_types", str(landing)).mode is None
    assert names(spark, made) == [(1, "x"), (2, "x"), (3, "x")]


def test_both_ways_of_loading_know_each_others_files(spark, made, tmp_path):
    landing, state = tmp_path / "landing", str(tmp_path / "state")
    write_pages(landing, user_types((1, "a", when(1))))
    stream = lambda: run_bronze_new_files(spark, made, "user_types", str(landing), state, file_per_envelope=True)
    report = stream()
    assert (report.rows, report.complete, report.files, report.undated, report.missing_pages) == (1, True, 1, 0, 0)
    assert run_bronze(spark, made, "user_types", str(landing), file_per_envelope=True).mode is None
    assert stream().mode is None


# --- loads are whole -------------------------------------------------------------------


def test_a_repeated_batch_appends_nothing(spark, made, tmp_path, monkeypatch):
    landing, state = tmp_path / "landing", str(tmp_path / "state")
    stream = lambda: run_bronze_new_files(spark, made, "user_types", str(landing), state, file_per_envelope=True)
    whole = landing_stream.load_envelopes

    def dies(*args, **kwargs):
        whole(*args, **kwargs)
        raise Stop

    for number in (1, 2):
        write_pages(landing, user_types((number, "x", when(number))), first=number)
        monkeypatch.setattr(landing_stream, "load_envelopes", dies)
        with pytest.raises(Exception, match="Stop"):
            stream()
        monkeypatch.setattr(landing_stream, "load_envelopes", whole)
        assert stream().mode is None
        assert names(spark, made) == [(n, "x") for n in range(1, number + 1)]


def test_a_load_that_dies_adds_nothing_and_is_repeated(spark, made, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    load = lambda: run_bronze(spark, made, "user_types", str(landing), file_per_envelope=True)
    write_pages(landing, user_types((1, "a", when(1))))
    load()
    write_pages(landing, user_types((2, "b", when(2))), first=2)

    def dies(*_):
        raise Stop

    monkeypatch.setattr(folders, "move", dies)
    with pytest.raises(Stop):
        load()
    monkeypatch.undo()
    assert names(spark, made) == [(1, "a")]
    assert load().rows == 1 and names(spark, made) == [(1, "a"), (2, "b")]


def test_of_two_loads_at_once_the_later_plans_anew(spark, made, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    load = lambda: run_bronze(spark, made, "user_types", str(landing), file_per_envelope=True)
    write_pages(landing, user_types((1, "a", when(1))))
    load()
    write_pages(landing, user_types((2, "b", None)), first=2)
    whole, first = jobs.load_envelopes, []

    def other_first(*args, **kwargs):
        monkeypatch.setattr(jobs, "load_envelopes", whole)
        first.append(load())
        return whole(*args, **kwargs)

    monkeypatch.setattr(jobs, "load_envelopes", other_first)
    assert load().mode is None and first[0].rows == 1
    assert names(spark, made) == [(1, "a"), (2, "b")]


def test_overtaken_loads_leave_no_trace(spark, made, tmp_path):
    table = made.table("bronze", "numbers")
    replace_loads(spark, table, Load(spark.range(3)), str(tmp_path / "n"))
    before = ledger(spark, table)
    assert append_load(spark, table, Load(spark.range(2)), before) == 2
    with pytest.raises(Overtaken):
        append_load(spark, table, Load(spark.range(5)), before)
    assert spark.table(table).count() == 5 and ledger(spark, table).numbers == (1, 2)
    assert not [n for n in folders.children(spark, before.location) if n.startswith("_")]
    only_second = ledger(spark, table).rows(spark, table, ledger(spark, table).ids[1:])
    assert only_second.count() == 2 and all("load-00000002" in f for f in only_second.inputFiles())
    replace_loads(spark, table, Load(spark.range(1)), str(tmp_path / "n"))
    with pytest.raises(Overtaken):
        append_load(spark, table, Load(spark.range(5)), ledger(spark, table).__class__(before.location, (1,)))
    assert spark.table(table).count() == 1


def test_bucketed_loads(spark, lake, tmp_path):
    made = Lakehouse(lake.bronze, lake.silver, lake.gold, "b_", None, {"bronze.user_types": (2, "userTypeId")})
    landing = tmp_path / "landing"
    for n in (1, 2):
        write_pages(landing, user_types((n, "x", when(n))), first=n)
        assert run_bronze(spark, made, "user_types", str(landing), file_per_envelope=True).rows == 1
    assert names(spark, made) == [(1, "x"), (2, "x")]
    rows = spark.table(made.table("bronze", "user_types"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = rows.groupBy("userTypeId").count()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan


# --- replacements ----------------------------------------------------------------------


def stopping_at(monkeypatch, step: int):
    """Let the driver die at the ``step``-th change of the catalog or removal."""
    sql, remove, state = SparkSession.sql, folders.remove, {"n": 0, "stopped": False}

    def watched(whole, counts):
        def call(*args, **kwargs):
            if counts(args[1]):
                state["n"] += 1
                if state["n"] > step:
                    state["stopped"] = True
                    raise Stop
            return whole(*args, **kwargs)

        return call

    monkeypatch.setattr(SparkSession, "sql", watched(sql, lambda text: text.startswith(("ALTER", "CREATE", "DROP"))))
    monkeypatch.setattr(folders, "remove", watched(remove, lambda _: True))
    return state


@pytest.mark.parametrize("external", [False, True])
@pytest.mark.parametrize("kind", ["same", "wider", "other"])
def test_a_replacement_stopped_at_any_step(spark, lake, tmp_path, monkeypatch, external, kind):
    news = {
        "same": spark.range(7).withColumn("v", F.lit("new")),
        "wider": spark.range(7).withColumns({"v": F.lit("new"), "w": F.lit(1)}),
        "other": spark.range(7).select(F.col("id").cast("string"), F.lit("new").alias("v")),
    }
    step, seen = 0, set()
    while True:
        name = f"{lake.silver}.t{step}"
        path = str(tmp_path / f"t{step}") if external else None
        write_table(spark.range(3).withColumn("v", F.lit("old")), name, path=path)
        state = stopping_at(monkeypatch, step)
        try:
            write_table(news[kind], name, path=path)
        except Stop:
            pass
        monkeypatch.undo()
        found = [tuple(r) for r in open_table(spark, name).groupBy("v").count().collect()]
        assert found in ([("old", 3)], [("new", 7)]), step
        seen.add(found[0][0])
        assert write_table(news[kind], name, path=path) == 7
        assert spark.table(name).count() == 7 and set(spark.table(name).columns) == set(news[kind].columns)
        if not state["stopped"]:
            break
        step += 1
    assert seen == {"old", "new"} and step >= 2


def test_a_half_done_replacement_is_ended(spark, lake):
    name = f"{lake.silver}.half"
    spark.range(4).write.saveAsTable(f"{name}__next")
    recover(spark, name)
    assert spark.table(name).count() == 4 and not spark.catalog.tableExists(f"{name}__next")


def test_files_of_others_stay(spark, lake, tmp_path):
    name, theirs = f"{lake.silver}.theirs", str(tmp_path / "data")
    spark.range(3).write.option("path", theirs).saveAsTable(name)
    write_table(spark.range(5), name)
    assert spark.table(name).count() == 5 and spark.read.parquet(theirs).count() == 3
    assert table_location(spark, name) != theirs


# --- Silver by buckets -----------------------------------------------------------------


def landed(tmp_path, number, rows):
    write_pages(tmp_path / "landing", rows, first=100 * number)
    return str(tmp_path / "landing")


def delta(spark, made, buckets=2):
    return run_silver_delta(spark, made, "user_types", buckets)


def load(spark, made, tmp_path, number, rows):
    return run_bronze(spark, made, "user_types", landed(tmp_path, number, rows), file_per_envelope=True)


@pytest.mark.parametrize("store", ["user_types", "user_types_versions"])
def test_a_lost_bucket_is_made_anew(spark, made, tmp_path, store):
    load(spark, made, tmp_path, 1, user_types(*((i, f"n{i}", when(1)) for i in range(20))))
    assert delta(spark, made).mode == "FULL"
    gone = next((tmp_path / "lake" / made.silver / store).glob("g-*/key_bucket=0"))
    shutil.rmtree(gone)
    load(spark, made, tmp_path, 2, user_types((1, "new", when(2))))
    delta(spark, made)
    assert names(spark, made, "silver") == [(i, "NEW" if i == 1 else f"N{i}") for i in range(20)]
    # a bucket that is lost is noticed without news as well
    shutil.rmtree(next((tmp_path / "lake" / made.silver / store).glob("g-*/key_bucket=1")))
    assert delta(spark, made).mode == "INCREMENTAL"
    assert len(names(spark, made, "silver")) == 20 and delta(spark, made).mode is None


def test_a_delta_stopped_at_any_step(spark, made, tmp_path, monkeypatch):
    load(spark, made, tmp_path, 0, user_types(*((i, f"n{i}", when(1)) for i in range(12))))
    delta(spark, made, 3)
    want = {i: f"N{i}" for i in range(12)}
    step, early = 0, 0
    while True:
        load(spark, made, tmp_path, step + 1, user_types((1, f"new{step}", None), (50 + step, "more", None)))
        state = stopping_at(monkeypatch, step)
        try:
            delta(spark, made, 3)
        except Stop:
            pass
        monkeypatch.undo()
        found = dict(names(spark, made, "silver"))
        assert want.keys() <= found.keys(), step  # no old key is ever missing
        want |= {50 + step: "MORE"}
        early += found.keys() != want.keys()
        delta(spark, made, 3)
        found = dict(names(spark, made, "silver"))
        assert found.keys() == want.keys() and all(found[i] == want[i] for i in range(2, 12)), step
        assert delta(spark, made, 3).mode is None
        if not state["stopped"]:
            break
        step += 3
    assert early >= 1 and step >= 6


def test_overlapping_loads_lose_no_row(spark, made, tmp_path, monkeypatch):
    load(spark, made, tmp_path, 1, user_types((1, "a", when(1))))
    delta(spark, made)
    whole = jobs.load_envelopes

    def late(*args, **kwargs):
        """A load that began before another one, which Silver takes, and ends after it."""
        monkeypatch.setattr(jobs, "load_envelopes", whole)
        load(spark, made, tmp_path, 3, user_types((3, "c", when(3))))
        delta(spark, made)
        return whole(*args, **kwargs)

    monkeypatch.setattr(jobs, "load_envelopes", late)
    load(spark, made, tmp_path, 2, user_types((2, "b", None)))
    delta(spark, made)
    assert names(spark, made, "silver") == [(1, "A"), (2, "B"), (3, "C")]


def test_of_two_deltas_at_once_both_end_well(spark, made, tmp_path, monkeypatch):
    load(spark, made, tmp_path, 1, user_types(*((i, "a", when(1)) for i in range(8))))
    delta(spark, made)
    load(spark, made, tmp_path, 2, user_types(*((i, "b", when(2)) for i in range(4))))
    whole = jobs.commit_buckets

    def other_first(*args):
        monkeypatch.setattr(jobs, "commit_buckets", whole)
        assert delta(spark, made).mode == "INCREMENTAL"
        return whole(*args)

    monkeypatch.setattr(jobs, "commit_buckets", other_first)
    assert delta(spark, made).mode is None
    assert names(spark, made, "silver") == [(i, "B" if i < 4 else "A") for i in range(8)]


def test_spellings_of_a_key_share_a_bucket(spark, made, tmp_path):
    load(spark, made, tmp_path, 1, user_types(*((i, "a", when(1)) for i in range(8))))
    delta(spark, made, 4)
    load(spark, made, tmp_path, 2, user_types(("007", "b", when(2)), (" 3", "c", when(2))))
    delta(spark, made, 4)
    found = without_stamp(spark.table(made.table("silver", "user_types"))).select("userTypeId", "name").collect()
    assert sorted(map(tuple, found)) == sorted([*((i, "A") for i in range(8)), (7, "B"), (3, "C")])


def test_a_replaced_bronze_table_is_taken_whole(spark, made, tmp_path):
    load(spark, made, tmp_path, 1, user_types((1, "a", when(1)), (2, "b", when(1))))
    delta(spark, made)
    other = tmp_path / "other"
    path = landed(other, 1, user_types((2, "z", when(1))))
    run_bronze(spark, made, "user_types", path, file_per_envelope=True, force_full=True)
    assert delta(spark, made).mode == "FULL" and names(spark, made, "silver") == [(2, "Z")]
    assert delta(spark, made, 5).mode == "FULL" and names(spark, made, "silver") == [(2, "Z")]
    run_silver(spark, made, "user_types")
    assert names(spark, made, "silver") == [(2, "Z")]
    assert delta(spark, made, 5).mode == "FULL" and names(spark, made, "silver") == [(2, "Z")]


# --- parents and children ----------------------------------------------------------------


def test_missing_parents_by_bitmaps(spark, made, tmp_path, monkeypatch):
    folder = tmp_path / "results"
    folder.mkdir()

    def results(*parents):
        for p in parents:
            page = {"evaluationId": p, "data": [{"resultId": f"{p}1"}, {"resultId": f"{p}2"}], "meta": {}}
            (folder / f"{p}.json").write_text(json.dumps(page))
        return run_bronze(spark, made, "evaluations_results", str(folder), inclusive=True).missing_parents

    write_pages(tmp_path / "e", [{"evaluationId": i, "updatedAt": when(1)} for i in (1, 2, 70_000, 5_000_000_000, -3, 1)])
    assert run_bronze(spark, made, "evaluations", str(tmp_path / "e"), file_per_envelope=True).missing_parents is None
    monkeypatch.setattr(jobs, "missing_parents", None)  # the rows of neither table are compared
    assert results(1, 99) == 4
    assert results(70_000, -3) == 2
    write_pages(tmp_path / "e", [{"evaluationId": 8, "updatedAt": when(2)}], first=50)
    run_bronze(spark, made, "evaluations", str(tmp_path / "e"), file_per_envelope=True)
    assert results(2, 8) == 1
    # keys that are no whole numbers are compared as they are
    monkeypatch.undo()
    assert results("x") == 1


# --- facts by buckets ------------------------------------------------------------------


FACT = "fato_checklists_aplicados"


def evaluations(*rows):
    return [{"evaluationId": i, "checklistId": c, "status": 6, "updatedAt": w} for i, c, w in rows]


def facts(spark, made):
    rows = open_table(spark, made.table("gold", FACT)).select("id_original_checklist_aplicado", "sk_checklist", "sk_status")
    return sorted(map(tuple, rows.collect()))


@pytest.fixture
def star(spark, made, tmp_path):
    """Evaluations 0 to 11 with checklists 0 to 3, of which 3 is not there yet."""

    def build(number, **entities):
        for entity, rows in entities.items():
            write_pages(tmp_path / "landing" / entity, rows, first=100 * number)
            run_bronze(spark, made, entity, str(tmp_path / "landing" / entity), file_per_envelope=True)
            if entity == "evaluations":
                run_silver_delta(spark, made, entity, 4)
            else:
                run_silver(spark, made, entity)
        for dim in ("dim_status", "dim_plataforma", "dim_checklists", "dim_unidades", "dim_usuario"):
            run_gold(spark, made, dim)
        return run_gold_delta(spark, made, FACT)

    checklists = [{"checklistId": i, "updatedAt": when(1)} for i in range(3)]
    one = {"units": [{"unitId": 1, "updatedAt": when(1)}], "users": [{"userId": 1, "updatedAt": when(1)}]}
    one["user_types"] = user_types((1, "t", when(1)))
    report = build(1, checklists=checklists, **one, evaluations=evaluations(*((i, i % 4, when(1)) for i in range(12))))
    assert (report.mode, report.rows) == ("FULL", 12)
    return build


def test_facts_follow_changes_by_bucket(spark, made, tmp_path, star):
    files = lambda: set((tmp_path / "lake" / made.gold / FACT).glob("g-*/key_bucket=*/part-*"))

    def same_as_full():
        found = facts(spark, made)
        full = Lakehouse(made.bronze, made.silver, f"{made.gold}_full", location=made.location)
        full.create_databases(spark)
        for dim in ("dim_status", "dim_plataforma", "dim_checklists", "dim_unidades", "dim_usuario", FACT):
            run_gold(spark, full, dim)
        assert found == facts(spark, full)
        return found

    assert run_gold_delta(spark, made, FACT).mode is None
    before = files()
    # one changed evaluation
    report = star(2, evaluations=evaluations((5, 2, when(2))))
    assert report.mode == "INCREMENTAL" and report.rows < 12
    assert len(before & files()) == 3 and len(files()) == 4
    changed = {i: c for i, c, _ in same_as_full()}
    assert changed[5] == changed[2] and changed[3] is None
    # a checklist that was missed appears: every bucket with a row that refers to it
    report = star(3, checklists=[{"checklistId": 3, "updatedAt": when(2)}])
    assert report.mode == "INCREMENTAL" and all(c is not None for _, c, _ in same_as_full())
    # a lost bucket is made anew
    shutil.rmtree(next(iter(files())).parent)
    assert run_gold_delta(spark, made, FACT).mode == "INCREMENTAL" and len(facts(spark, made)) == 12
    # Silver built anew is taken whole
    run_silver(spark, made, "evaluations")
    run_silver_delta(spark, made, "evaluations", 4)
    assert run_gold_delta(spark, made, FACT).mode == "FULL" and len(same_as_full()) == 12


def test_facts_need_buckets(spark, lake):
    with pytest.raises(ValueError, match="run_silver_delta"):
        run_gold_delta(spark, lake, FACT)
    with pytest.raises(SystemExit):
        main(["gold", "dim_status", "--delta"], spark)


# --- registered keys -------------------------------------------------------------------


def test_registered_keys_are_never_shared(spark, lake, tmp_path, monkeypatch):
    from starlode.operators import keymap

    # a poor hash, so that keys collide
    monkeypatch.setattr(keymap, "surrogate_key", lambda key: F.pmod(F.length(key), F.lit(3)).cast("long"))
    table, root = f"{lake.gold}.keys", str(tmp_path / "keys")
    register = lambda *keys: keymap.register_keys(
        spark, table, root, spark.createDataFrame([(k,) for k in keys], "k string"), "k"
    )
    assert (register("b", "a", None, "ccc", "a"), register("a"), register("d", "c", "a", "dddd")) == (3, 0, 3)
    rows = spark.table(table).select("natural", keymap.registered_key()).collect()
    span = 1 << 32
    assert {tuple(r) for r in rows} == {
        ("a", 1), ("b", 1 + span), ("ccc", 0), ("c", 1 + 2 * span), ("d", 1 + 3 * span), ("dddd", 1 + 4 * span),
    }
    df = spark.createDataFrame([("a",), (None,), ("unknown",)], "k string")
    assert {tuple(r) for r in keymap.with_registered_key(df, "k", spark.table(table), "sk").collect()} == {
        ("a", 1), (None, None), ("unknown", None),
    }


# --- pages -----------------------------------------------------------------------------


@pytest.mark.parametrize("block", [3, 1 << 20])
def test_gaps_of_pages(spark, block):
    rows = [("a", 1), ("a", 2), ("a", 2), ("a", 5), ("a", 12), ("b", 3), ("c", 1), (None, 2), ("d", None), ("a", 0)]
    df = spark.createDataFrame(rows, "set string, page int")
    got = {tuple(r) for r in page_gaps(df, ["set"], block=block).collect()}
    assert got == {("a", 3, 4), ("a", 6, 11), ("b", 1, 2), (None, 1, 1)}
    assert page_gaps(df.limit(0), ["set"]).isEmpty()
    alone = page_gaps(df.where("set = 'b'"), block=block).collect()
    assert [tuple(r) for r in alone] == [(1, 2)]


def test_page_numbers(spark, tmp_path):
    paths = ["file:/x/page_archive/page-007.json", "file:/x/page12_a.json", "file:/x/other.json"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    page, pages_of = page_of_file(F.col("path"), jobs.PAGE_FILE)
    assert [tuple(r) for r in df.select(page, pages_of).collect()] == [
        (7, "file:/x/page_archive/"), (12, "file:/x/"), (None, None),
    ]
    lines = [{"data": [], "meta": {"page": p}} for p in (1, "4", "x")] + [{"data": []}]
    (tmp_path / "p.json").write_text("\n".join(map(json.dumps, lines)))
    envelopes = read_envelopes(spark, str(tmp_path)).select(page_of_envelope().alias("page"))
    assert [r[0] for r in envelopes.collect()] == [1, 4, None, None]
    assert [tuple(r) for r in page_gaps(envelopes).collect()] == [(2, 3)]


@pytest.mark.parametrize("by_stream", [False, True])
@pytest.mark.parametrize("file_per_envelope", [False, True])
def test_malformed_pages_are_put_aside(spark, made, tmp_path, file_per_envelope, by_stream):
    landing = tmp_path / "landing"
    whole = [{"data": user_types((n, "x", when(n))), "meta": {"hasMore": n == 1}} for n in (1, 2)]
    texts = [json.dumps(whole[0]), '{"data": [{"userTypeId": 9, "na', json.dumps(whole[1])]
    landing.mkdir()
    if file_per_envelope:
        for n, text in enumerate(texts, 1):
            (landing / f"page_{n}.json").write_text(text)
    else:
        (landing / "pages.json").write_text("\n".join(texts))

    def run(**kwargs):
        if by_stream:
            return run_bronze_new_files(
                spark, made, "user_types", str(landing), str(tmp_path / "state"), file_per_envelope=file_per_envelope, **kwargs
            )
        return run_bronze(spark, made, "user_types", str(landing), file_per_envelope=file_per_envelope, **kwargs)

    if not by_stream:
        with pytest.raises(Exception, match="(?i)malformed"):
            run()
    report = run(quarantine=True)
    assert (report.rows, report.rejected, report.complete) == (2, 1, True)
    assert names(spark, made) == [(1, "x"), (2, "x")]
    (bad,) = spark.table(made.table("bronze", "user_types_rejected")).collect()
    assert bad.page == texts[1] and bad.file.endswith(".json")
    assert run(quarantine=True).mode is None


def test_every_spelling_is_kept(spark, tmp_path):
    records = [
        {"updatedAt": 1, "UpdatedAt": 2, "UPDATEDAT": 3, "x": 4},
        {"NAME": "a", "Name": "b", "nAME": "c"},
        {"name": None, "Name": "late", "NAME": "left"},
        {"name": "n"},
    ]
    (tmp_path / "p.json").write_text(json.dumps({"data": records}))
    found = all_fields(explode_records(read_envelopes(spark, str(tmp_path))), ["updatedAt", "name"]).collect()
    assert [(r.updatedAt, r.name, r[OTHER]) for r in found] == [
        ("1", None, {"UpdatedAt": "2", "UPDATEDAT": "3", "x": "4"}),
        (None, "a", {"Name": "b", "nAME": "c"}),
        (None, "late", {"NAME": "left"}),
        (None, "n", None),
    ]


# --- command line ----------------------------------------------------------------------


def test_state_honours_or_refuses(spark, lake, tmp_path, capsys):
    where = ["--bronze", lake.bronze, "--silver", lake.silver, "--gold", lake.gold]
    folder = tmp_path / "landing" / "evaluations_results"
    folder.mkdir(parents=True)
    (folder / "parent_77.json").write_text(json.dumps({"data": [{"resultId": 5}]}, indent=1))
    common = ["--landing", str(tmp_path / "landing"), "--state", str(tmp_path / "state"), *where]
    (report,) = main(
        ["bronze", "evaluations_results", "--file-per-envelope", "--parent-pattern", r"parent_(\d+)", *common], spark
    )
    assert (report.rows, report.complete, report.undated) == (1, True, 1)
    assert [r.evaluationId for r in spark.table(f"{lake.bronze}.evaluations_results").collect()] == ["77"]
    for refused in ("--force-full", "--inclusive", "--reread"):
        with pytest.raises(SystemExit):
            main(["bronze", "evaluations_results", refused, *common], spark)
        assert refused in capsys.readouterr().err


def test_everything_by_state(spark, lake, tmp_path):
    from tests.landed import land

    where = ["--bronze", lake.bronze, "--silver", lake.silver, "--gold", lake.gold]
    call = ["all", "--landing", str(land(tmp_path)), "--state", str(tmp_path / "state"), "--file-per-envelope"]
    call += ["--parent-pattern", r"parent_(\d+)", *where]
    first, again = main(call, spark), main(call, spark)
    assert {r.table: r.rows for r in first}[f"{lake.gold}.fato_checklists_aplicados_resultados"] == 4
    assert {r.mode for r in again if re.match(lake.bronze, r.table)} == {None}
