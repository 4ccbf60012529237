"""One-pass upserts, versions by key range, bronze as a stream, ingestion that reads only what is new."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from credlake import schemas as S
from credlake.operators.upsert import insert_ignore, upsert
from credlake.plans import run as R
from credlake.plans.run import current_view, ingest_batch, init_warehouse, load_silver, run_load
from credlake.sources import files
from credlake.sources.files import open_deliveries, read_application_csv
from credlake.sources.store import TableStore
from credlake.streaming.file_ingest import run_bronze_stream

BRONZE, SILVER, FACT, CLIENT = "bronze.raw_application", "silver.cleaned_application", "gold.fact_creditos", "gold.dim_cliente"
DAY = dt.date(2024, 1, 7)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def bronze(spark, ids, seq=1, income=500.0, documents=False):
    rows = []
    for k, i in enumerate(ids):
        p = {"SK_ID_CURR": str(i), "NAME_CONTRACT_TYPE": f"Cash {i % 3}", "AMT_CREDIT": 1000.0, "AMT_INCOME_TOTAL": income}
        if documents:
            p = {"SK_ID_CURR": str(i), "AMT_INCOME_TOTAL": income, S.DOC_METADATA_KEY: {"document_type": "d", "confidence_score": 90.0}}
        rows.append((seq + k, str(i), json.dumps(p), "run", "f", dt.datetime(2024, 1, 1), documents))
    return spark.createDataFrame(rows, S.BRONZE)


def files_of(store, table):
    """{folder/range: {file: (size, bytes)}} of the current content."""
    out = {}
    for folder, held in store._layout(table):
        for r in held:
            path = f"{folder}/{r}".removeprefix("file:")
            out[r] = {n: open(f"{path}/{n}", "rb").read() for n in os.listdir(path) if n.endswith(".parquet")}
    return out


@pytest.mark.parametrize("sk", [None, "sk"])
def test_upsert_shuffles_each_side_once(spark, sk):
    target = spark.range(1000).select(*([F.col("id").cast("int").alias("sk")] if sk else []), F.col("id").cast("int").alias("k"), F.lit("a").alias("v"))
    source = spark.range(500, 1500).select(F.col("id").cast("int").alias("k"), F.lit("b").alias("v"))
    plan = []
    if sk:
        import credlake.operators.upsert as U
        store, U.materialize = U.materialize, lambda df, *a: plan.append(plan_of(df)) or store(df)
        try:
            out = upsert(target, source, ["k"], sk_col=sk)
        finally:
            U.materialize = store
    else:
        out = upsert(target, source, ["k"])
        plan.append(plan_of(out))
    assert len(plan) == 1 and plan[0].count("Exchange hashpartitioning") == 1 and "Join" not in plan[0]
    rows = {r["k"]: r for r in out.collect()}
    assert len(rows) == 1500 and rows[499]["v"] == "a" and rows[500]["v"] == rows[1499]["v"] == "b"
    if sk:
        assert [rows[k]["sk"] for k in (0, 999, 1000, 1499)] == [0, 999, 1000, 1499]


def test_upsert_of_text_keys_updates_and_numbers(spark):
    target = spark.createDataFrame([(1, "x", "a"), (2, "y", "b")], "sk int, k string, v string")
    source = spark.createDataFrame([("y", "B"), ("z", "c"), ("a", "d")], "k string, v string")
    got = sorted(map(tuple, upsert(target, source, ["k"], sk_col="sk").collect()))
    assert got == [(1, "x", "a"), (2, "y", "B"), (3, "a", "d"), (4, "z", "c")]
    with pytest.raises(Exception, match="twice"):
        upsert(target, source.unionByName(source), ["k"], sk_col="sk").collect()
    two = upsert(target.drop("sk"), source, ["k", "v"]).collect()
    assert len(two) == 5


def test_insert_ignore_takes_the_first_of_repeated_keys(spark):
    target = spark.createDataFrame([(7, 1, "a")], "sk int, k int, v string")
    source = spark.createDataFrame([(1, "x"), (2, "b"), (2, "b"), (None, "n")], "k int, v string")
    got = sorted(map(tuple, insert_ignore(target, source, ["k"], sk_col="sk").collect()), key=str)
    assert [r for r in got if r[1]] == [(7, 1, "a"), (9, 2, "b")] and [r[2] for r in got if r[1] is None] == ["n"]


def test_a_load_writes_only_the_ranges_it_touches(spark, tmp_root):
    store = TableStore(spark, root=f"{tmp_root}/wh")
    init_warehouse(store)
    ids = [1, 2, 65536, 65537, 200000]
    run_load(spark, store, "r1", bronze_rows=bronze(spark, ids), as_of=DAY, incremental=True, view_name="v_rangos")
    before = {t: files_of(store, t) for t in (SILVER, FACT, CLIENT)}
    stamps = {r["bk_id_solicitud"]: r["fecha_ingestion"] for r in store.read(SILVER).collect()}
    new = bronze(spark, [65536], seq=10, income=50.0, documents=True).unionByName(bronze(spark, [65540], seq=20))
    run_load(spark, store, "r2", bronze_rows=new, as_of=dt.date(2024, 1, 9), incremental=True, view_name="v_rangos")
    for t in (SILVER, FACT, CLIENT):
        after = files_of(store, t)
        assert set(after) == {"rango_clave=0", "rango_clave=1", "rango_clave=3"}
        assert [r for r in after if after[r] != before[t][r]] == ["rango_clave=1"]
        newest = store.current_path(t).removeprefix("file:")
        assert newest.rsplit("/", 1)[1].startswith("p=") and [n for n in os.listdir(newest) if n.startswith("rango")] == ["rango_clave=1"]
    fact = {r["dd_id_solicitud"]: r for r in store.read(FACT).collect()}
    assert sorted(r["sk_fact"] for r in fact.values()) == [1, 2, 3, 4, 5, 6] and fact[65540]["sk_fact"] == 6
    assert fact[65536]["amt_income_total"] == 50 and fact[65537]["via_airflow_run_id"] == "r1"
    assert {k: r["sk_tiempo"] for k, r in fact.items() if r["sk_tiempo"] == 2}.keys() == {65536, 65540}
    again = {r["bk_id_solicitud"]: r["fecha_ingestion"] for r in store.read(SILVER).collect()}
    assert {k for k in stamps if again[k] != stamps[k]} == {65536}
    view = {r["id_solicitud"]: r["fecha_evaluacion_datos"] for r in spark.table("v_rangos").collect()}
    assert view == {r["id_solicitud"]: r["fecha_evaluacion_datos"] for r in current_view(store).collect()}
    assert view[65540] == dt.date(2024, 1, 9) and view[65537] == DAY and len(view) == 6
    # only some ranges are read; a whole version takes the place of all before it
    assert sorted(r["bk_id_solicitud"] for r in store.read(SILVER, [1]).collect()) == [65536, 65537, 65540]
    store.overwrite(SILVER, store.read(SILVER).where("bk_id_solicitud < 3"))
    assert store.read(SILVER).count() == 2
    store.prune(keep=1)
    assert len(store._folders(SILVER)) == 1 and store.read(FACT).count() == 6


def test_nothing_new_writes_nothing(spark, tmp_root):
    store = TableStore(spark, root=f"{tmp_root}/wh")
    store.append_bronze(bronze(spark, [1, 70000]))
    load_silver(store, incremental=True, run_id="r1")
    folders = store._folders(SILVER)
    path, changes = load_silver(store, incremental=True, run_id="r2")
    assert path is None and changes.ranges == [] and store._folders(SILVER) == folders


def test_a_failed_silver_load_is_repeated(spark, tmp_root, monkeypatch):
    from credlake.operators.quality import ConstraintError
    store = TableStore(spark, root=f"{tmp_root}/wh")
    store.append_bronze(bronze(spark, [1, 2]))
    commit = TableStore.overwrite

    def fail(self, *a, **kw):
        raise ConstraintError("planted")

    monkeypatch.setattr(TableStore, "overwrite", fail)
    with pytest.raises(ConstraintError, match="planted"):
        load_silver(store, incremental=True, run_id="r1")
    monkeypatch.setattr(TableStore, "overwrite", commit)
    load_silver(store, incremental=True, run_id="r2")                    # the same files come again
    assert store.read(SILVER).count() == 2 and store.read("audit.silver_ledger").count() > 0


def test_a_reset_forgets_what_silver_has_seen(spark, tmp_root):
    store = TableStore(spark, root=f"{tmp_root}/wh")
    store.append_bronze(bronze(spark, [1, 2]))
    load_silver(store, incremental=True, run_id="r1")
    init_warehouse(store)
    assert store.read(SILVER).count() == 0
    load_silver(store, incremental=True, run_id="r2")
    assert store.read(SILVER).count() == 2


def _drop(folder, *names):
    os.makedirs(folder, exist_ok=True)
    for n in names:
        with open(f"{folder}/{n}.json", "w") as f:
            f.write(json.dumps({"SK_ID_CURR": n, "AMT_INCOME_TOTAL": 1.0}, indent=1) if n.isdigit() else "{")


def test_only_new_files_are_read(spark, tmp_root, monkeypatch):
    store, raw = TableStore(spark, root=f"{tmp_root}/wh"), f"{tmp_root}/raw"
    read, seen = R.read_documents, []
    monkeypatch.setattr(R, "read_documents", lambda s, paths, **kw: seen.append(sorted(p.rsplit("/", 1)[1] for p in paths)) or read(s, paths, **kw))
    _drop(raw, "1", "2")
    ingest_batch(spark, store, "r1", docs_dir=raw, docs_pattern="*.json")
    _drop(raw, "3")
    ingest_batch(spark, store, "r2", docs_dir=raw, docs_pattern="*.json")
    assert seen == [["1.json", "2.json"], ["3.json"]]
    assert sorted(r[0] for r in store.read(BRONZE).select("bk_id_solicitud").collect()) == ["1", "2", "3"]


def test_sequence_numbers_need_no_bronze_and_survive_a_failed_load(spark, tmp_root, monkeypatch):
    import credlake.operators.ledger as L
    store, raw = TableStore(spark, root=f"{tmp_root}/wh"), f"{tmp_root}/raw"
    _drop(raw, "1", "2", "bad")
    monkeypatch.setattr(L, "max_key", lambda *a: 0)
    ingest_batch(spark, store, "r1", docs_dir=raw, docs_pattern="*.json")
    monkeypatch.setattr(L, "max_key", lambda *a: pytest.fail("bronze is read for its numbers"))
    _drop(raw, "3", "4")
    entry = R.ledger_entry
    monkeypatch.setattr(R, "ledger_entry", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        ingest_batch(spark, store, "r2", docs_dir=raw, docs_pattern="*.json")   # rows are in bronze, the ledger does not know
    monkeypatch.setattr(R, "ledger_entry", entry)
    ingest_batch(spark, store, "r3", docs_dir=raw, docs_pattern="*.json")
    rows = store.read(BRONZE).select("id_secuencial", "bk_id_solicitud").collect()
    assert len(rows) == len({r[0] for r in rows}) == 6
    of = {}
    for n, k in sorted((r[0], r[1]) for r in rows):
        of[k] = n
    assert min(of["3"], of["4"]) > max(of["1"], of["2"])


def test_a_delivery_is_archived_by_one_rename(spark, tmp_root, monkeypatch):
    store, raw, arch = TableStore(spark, root=f"{tmp_root}/wh"), f"{tmp_root}/raw", f"{tmp_root}/archive"
    args = dict(docs_dir=raw, docs_pattern="*.json", archive_dir=arch, archive_by="delivery")
    monkeypatch.setattr(R, "archive_file", lambda *a: pytest.fail("a rename a file"))
    _drop(raw, "1", "bad")
    append = TableStore.append_bronze
    monkeypatch.setattr(TableStore, "append_bronze", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        ingest_batch(spark, store, "r1", **args)
    assert os.listdir(raw) == [] and len(open_deliveries(spark, arch, "documentos")) == 1
    monkeypatch.setattr(TableStore, "append_bronze", append)
    _drop(raw, "1")                                                       # a new delivery under an old name
    c = ingest_batch(spark, store, "r1", **args)                          # the old one is found again
    assert (c["documentos_filas"], c["documentos_cuarentena"]) == (2, 1) and open_deliveries(spark, arch, "documentos") == []
    assert sorted(n for n in os.listdir(arch) if not n.startswith(".")) == ["documentos-r1", "documentos-r1.1"]
    assert ingest_batch(spark, store, "r2", **args) == {}
    with open(f"{tmp_root}/a.csv", "w") as f:
        f.write("SK_ID_CURR,T\n5,1\n")
    c = ingest_batch(spark, store, "r3", csv_path=f"{tmp_root}/a.csv", archive_dir=arch, archive_by="delivery")
    assert c == {"csv_filas": 1} and not os.path.exists(f"{tmp_root}/a.csv") and os.path.exists(f"{arch}/csv-r3/a.csv")
    with pytest.raises(ValueError):
        ingest_batch(spark, store, "r4", docs_dir=raw, archive_dir=arch, archive_by="x")


def test_stream_counters(spark, tmp_root):
    store, raw = TableStore(spark, root=f"{tmp_root}/wh"), f"{tmp_root}/raw"
    _drop(raw, "1", "2", "3", "bad")
    args = (store, raw, f"{tmp_root}/ck", f"{tmp_root}/q", "r")
    want = {"documentos": 4, "documentos_filas": 3, "documentos_cuarentena": 1}
    assert run_bronze_stream(spark, *args, pattern="*.json", max_files_per_trigger=2) == want
    assert store.read(BRONZE).count() == 3
    assert run_bronze_stream(spark, *args, pattern="*.json") == {}        # nothing new: no batch
    marks = [r["marca"] for r in store.read("bronze.ingested_files").collect()]
    assert len({m for m in marks if m is not None}) == 2                  # one reservation a batch
    assert len({r[0] for r in store.read(BRONZE).select("id_secuencial").collect()}) == 3


def test_bucketed_view_needs_no_shuffle(spark, tmp_root):
    store = TableStore(spark, root=f"{tmp_root}/wh")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for i in range(3):
        run_load(spark, store, f"r{i}", bronze_rows=bronze(spark, [1, 2, 70000], seq=1 + 10 * i), as_of=DAY, view_name="v_cubetas", view_buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        names = [t.name for t in spark.catalog.listTables() if t.name.startswith("v_cubetas_")]
        fact, client = (spark.table(next(n for n in names if n.endswith(f"3_{k}"))) for k in "fc")
        assert "Exchange" not in plan_of(fact.join(client, "sk_cliente"))
        assert spark.table("v_cubetas").count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert sorted(names) == [f"v_cubetas_{n}_{k}" for n in (2, 3) for k in "cf"]
    spark.sql("DROP VIEW v_cubetas")
    for n in names:
        spark.sql(f"DROP TABLE {n}")


def test_csv_cells_with_line_breaks(spark, tmp_root):
    os.makedirs(tmp_root, exist_ok=True)
    with open(f"{tmp_root}/x.csv", "w") as f:
        f.write('SK_ID_CURR,T\n1,"two\nlines, ""quoted"""\n2,one\n')
    assert [r["T"] for r in read_application_csv(spark, f"{tmp_root}/x.csv", multi_line=True).collect()] == ['two\nlines, "quoted"', "one"]
    with open(f"{tmp_root}/y.csv", "w") as f:
        f.write('SK_ID_CURR,T,U\n1,"two\nlines",x\n')
    with pytest.raises(Exception):
        read_application_csv(spark, f"{tmp_root}/y.csv").collect()


def test_row_rules_are_counted_while_writing(spark, tmp_root, monkeypatch):
    from credlake.operators import quality as Q
    store = TableStore(spark, root=f"{tmp_root}/wh")
    monkeypatch.setattr(Q, "row_violations", lambda *a: pytest.fail("a pass of its own"))
    schema = S.T.StructType([S.T.StructField(f.name, f.dataType, True) for f in S.SILVER.fields])
    rows = [tuple({"bk_id_solicitud": i, "code_gender": g}.get(c) for c in schema.fieldNames()) for i, g in ((1, "F"), (None, "x" * 11))]
    with pytest.raises(Q.ConstraintError, match="nulo_bk_id_solicitud .1., largo_code_gender .1."):
        store.overwrite(SILVER, spark.createDataFrame(rows, schema), check=Q.constraint_check(SILVER, store.read))
    store.overwrite(SILVER, spark.createDataFrame(rows[:1], schema), check=Q.constraint_check(SILVER, store.read))
    assert store.read(SILVER).count() == 1


def test_claimed_names(spark, tmp_root):
    files.claim_delivery(spark, f"{tmp_root}/absent", f"{tmp_root}/archive", "documentos-r")
    os.makedirs(f"{tmp_root}/empty")
    files.claim_delivery(spark, f"{tmp_root}/empty", f"{tmp_root}/archive", "documentos-r")
    assert not os.path.exists(f"{tmp_root}/archive") and os.path.exists(f"{tmp_root}/empty")
