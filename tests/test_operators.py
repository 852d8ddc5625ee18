"""Operators on small hand-made rows."""

import uuid

import pytest
from pyspark.sql import Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.functions.phonetic import double_metaphone, jaro_winkler
from tidewater.functions.strings import correct
from tidewater.lineage import Log, Traced
from tidewater.operators import fill, idem, ingest, linkage, migrate, structure
from tidewater.session import LakeConfig
from tidewater.sources.store import TableStore, upsert


def one(spark, column, **values):
    return spark.createDataFrame([Row(**values)]).select(column.alias("x")).first()["x"]


def test_idem_pattern(spark):
    rows = spark.createDataFrame([(v,) for v in ["id", "ID.", "idem", "Iden", "idom", "Id. y id.", "idea", "iddem", "1dem", None]], "v string")
    assert [r["m"] for r in rows.select(idem.is_idem(F.col("v")).alias("m")).collect()] == [True] * 6 + [False] * 4


def test_idem_root(spark):
    data = [("bp", 1, "Id."), ("bp", 2, "brig"), ("bp", 3, "idem"), ("bp", 4, None), ("bp", 5, "ID"), ("bp", 6, "1dem"), ("bp", 7, "Id. y id."), ("xx", 1, "id")]
    schema = {"properties": {"v": {"type": "string", "for_cleaning": ["accepted_idem"]}}, "order_and_partitions": {"order": ["seq"], "partitions": ["p"]}}
    out = idem.resolve_idems(spark.createDataFrame(data, "p string, seq int, v string"), schema).orderBy("p", "seq")
    assert [r["v"] for r in out.collect()] == [None, "brig", "brig", None, "brig", "1dem", "1dem", None]
    with pytest.raises(ValueError):
        idem.resolve_idems(out, {"properties": {}})


def test_idem_array(spark):
    rows = [(1, ["wheat", "id."]), (2, ["id.", "corn"]), (3, ["id.", "Idem"]), (4, []), (5, ["id.", "id."]), (6, None), (7, ["id"])]
    df = spark.createDataFrame([(k, None if v is None else [Row(c=x) for x in v]) for k, v in rows], "k int, a array<struct<c:string>>")
    out = df.select("k", idem.resolve_array(F.col("a"), ["c"], ["c"], W.orderBy("k")).alias("a")).orderBy("k").collect()
    assert [None if r["a"] is None else [x["c"] for x in r["a"]] for r in out] == [["wheat", "wheat"], ["id.", "corn"], ["corn", "corn"], [], ["id.", "id."], None, ["id"]]


def test_idem_nested(spark):
    kind = "k int, a array<struct<m:string,cargo:array<struct<c:string>>>>"
    df = spark.createDataFrame([(1, [("A", [("x",), ("id.",)]), ("B", [("id.",)])])], kind)
    out = df.select(idem.resolve_nested(F.col("a"), "cargo", ["c"], ["m", "cargo"], ["c"], W.orderBy("k")).alias("a")).first()["a"]
    assert [[x["c"] for x in o["cargo"]] for o in out] == [["x", "x"], ["x"]]


def test_corrections(spark):
    c = correct(F.col("v"), {"O": "0", "l": "1", "rn": "m"})
    assert one(spark, c, v="1O5l") == "1051"
    assert one(spark, c, v="null") == "null"
    assert one(spark, c, v="corn") == "com"


def test_casts_never_raise(spark):
    df = spark.createDataFrame([("x", "[oops", "12")], "a string, b string, c string")
    schema = {"properties": {"a": {"type": "integer"}, "c": {"type": "integer"}}}
    row = structure.cast(df, schema).first()
    assert row["a"] is None and row["c"] == 12
    node = {"type": "array", "items": {"type": "string"}}
    assert df.select(structure.normalize_one(F.col("b"), node).alias("x")).first()["x"] is None


def test_fill_kinds(spark):
    df = spark.createDataFrame([(None, "b")], "a string, b string")
    run = lambda rule: fill.fill(df, {"properties": {"a": {"type": "string", "fill_with": rule}}}).first()["a"]
    assert run({"type": "replace", "from": "b"}) == "b"
    assert run({"type": "replace", "from": "missing"}) is None
    assert run({"type": "replace_if_not_exist", "from": "LIT('z')"}) == "z"
    assert run({"type": "replace", "from": "b", "condition": {"column": "b", "op": "isNull"}}) is None


def test_decrement(spark):
    d = lambda n, u: str(one(spark, structure.decrement_date(F.to_date(F.lit("1900-03-01")), F.lit(n), F.lit(u)), v=1))
    assert d("2", "days") == "1900-02-27" and d("30", "h.") == "1900-02-27" and d("1", "?") == "1900-02-28"


def test_reuse_ids_keeps_old_id_and_new_content(spark):
    old = spark.createDataFrame([("o1", "t", "old"), ("o2", "u", "old")], "entry_id string, parsed_text string, v string")
    new = spark.createDataFrame([("n1", "t", "new"), ("n2", "w", "new"), ("n3", "w", "new")], old.schema)
    assert sorted(tuple(r) for r in ingest.reuse_ids(old, new).select("entry_id", "parsed_text", "v").collect()) == [("n2", "w", "new"), ("o1", "t", "new"), ("o2", "u", "old")]


def test_store(spark, tmp_path):
    store = TableStore(spark, LakeConfig(base_path=str(tmp_path), project=uuid.uuid4().hex))
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert store.read("t") is None
    store.write(df, "t")
    store.write(spark.createDataFrame([(2, "c"), (3, "d")], df.schema), "t", mode="merge", key="k")
    assert sorted(map(tuple, store.read("t").collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(map(tuple, store.read("t", version=0).collect())) == [(1, "a"), (2, "b")]
    store.restore("t", version=0)
    assert store.read("t").count() == 2 and len(store.history("t")) == 3
    assert [store.sequence("s", increment=5), store.sequence("s")] == [0, 5]
    store.update_state(df.filter("k = 1"), "t", key="k", done=True)
    assert [r["k"] for r in store.pending(df, "t", key="k").collect()] == [2]
    with pytest.raises(ValueError):
        upsert(df, df.unionByName(df), "k")
    with pytest.raises(FileExistsError):
        store.write(df, "t", mode="error")


def test_lineage(spark, tmp_path):
    log = Log(TableStore(spark, LakeConfig(base_path=str(tmp_path))))

    @log.transformer
    def louder(frame):
        return frame.withColumn("w", F.upper("v"))

    frame = louder(Traced(spark.createDataFrame([("a",)], "v string"), "t"))
    assert frame.collect()[0]["w"] == "A" and frame.steps[0].changes == ["add_columns", "modify_columns"] and frame.name == "TR(t)"
    assert frame.groupBy("v").count().steps[-1].operation == "groupBy.count"
    both = frame.join(frame.select("v"), "v")
    assert "new_dataframe" in both.steps[-1].changes
    log.flush()
    assert log.read("process").first()["status"] == "OK"


def test_migrations(spark, tmp_path):
    steps = migrate.Migrations(TableStore(spark, LakeConfig(base_path=str(tmp_path))))
    seen = []
    steps.step(lambda s: seen.append(1))
    steps.step(lambda s: seen.append(2))
    assert steps.run() == "v2" and steps.run() == "v2" and seen == [1, 2]


def test_config_of_a_file(tmp_path):
    path = tmp_path / "cfg.json"
    path.write_text('{"protocol": "hdfs://", "base_path": "/lake", "configs": [{"spark.a": 1}, {"spark.b": "x"}], "spark.sql.shuffle.partitions": 8}')
    config = LakeConfig.from_json(str(path))
    assert config.path("news.raw") == "hdfs:///lake/default/ingest/news/raw"
    assert config.options == {"spark.a": "1", "spark.b": "x", "spark.sql.shuffle.partitions": "8"}
    assert LakeConfig.from_json(str(tmp_path / "none.json")) == LakeConfig()


def test_phonetic():
    assert abs(jaro_winkler("MARTHA", "MARHTA") - 0.9611) < 1e-4 and jaro_winkler("", "a") == 0.0
    assert double_metaphone("Smith") == ("SM0", "XMT") and double_metaphone("Thompson")[0].startswith("TM") and double_metaphone("") == ("", "")


def test_em_likelihood_never_falls(spark):
    df = spark.createDataFrame([(2, 1, 30), (0, 0, 500), (2, 0, 5), (0, 1, 20), (-1, 1, 3)], "gamma_a int, gamma_b int, n int")
    rows = df.select("gamma_a", "gamma_b", F.explode(F.sequence(F.lit(1), "n")))
    a, b = linkage.Comparison("a", "x", "y", (("levenshtein", 0.5),)), linkage.Comparison("b", "x", "y")
    u = linkage.estimate(rows, [a, b])
    model, history = linkage.maximise(rows, linkage.Model([a, b], {"a": [0.1, 0.1, 0.8], "b": [0.1, 0.9]}, u, 0.1))
    assert all(y >= x - 1e-9 for x, y in zip(history, history[1:]))
    assert all(abs(sum(p) - 1) < 1e-9 for p in [*model.m.values(), *model.u.values()])


def test_stream_upsert(spark, tmp_path):
    from tidewater.streaming.upsert import upsert_stream

    store = TableStore(spark, LakeConfig(base_path=str(tmp_path)))
    spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k int, v string, t int").write.parquet(f"{tmp_path}/in")
    upsert_stream(spark.readStream.schema("k int, v string, t int").parquet(f"{tmp_path}/in"), store, "s", key="k", order="t", checkpoint=f"{tmp_path}/cp").awaitTermination(60)
    assert sorted((r["k"], r["v"]) for r in store.read("s").collect()) == [(1, "b"), (2, "c")]


def test_linkage_training(spark, tmp_path):
    from tidewater.layers import Linkage

    layer = Linkage(LakeConfig(base_path=str(tmp_path)), spark)
    known = ["Cadiz", "Havana", "Lima", "Manila", "Veracruz"]
    cited = [(f"e{i}", f"t{i}", known[i % 5] if i % 3 else known[i % 5][:-1] + "x") for i in range(60)]
    entries = spark.createDataFrame(cited, "entry_id string, temp_key string, travel_departure_port string").withColumns({"travel_arrival_port": F.lit("x"), "travel_port_of_call_list": F.lit(None).cast("array<struct<port_of_call_place:string>>")})
    layer.store.write(entries, "ship_entries", level=1)
    layer.store.write(spark.createDataFrame([(k, k.lower(), [k, k.upper()]) for k in known], "name string, normalized_name string, voices array<string>"), "known_entities", "port", level=1)
    rows = [(f"t{i}", known[i % 5].lower() if i % 4 else "# unreadable") for i in range(60)]
    layer.store.write(spark.createDataFrame(rows, "temp_key string, rev_travel_departure_port string"), "reviewed_entries", "ship_entries", level=1)
    config = {"general_config_algorithms": {"lev": {"algorithm": "levenshtein", "thresholds": [0.7]}, "sound": {"algorithm": "soundex", "thresholds": [0.7]}}, "entity_categories": {"port": {"field_l": "citation", "field_r": "voice", "algorithms": ["lev", "sound"]}}}
    model = layer.train_ports(config)
    assert set(model.m) == set(model.u) == {"port", "port_soundex"} and 0 < model.match_share < 1
    assert model.m["port"][0] < model.u["port"][0] and all(abs(sum(p) - 1) < 1e-9 for p in model.u.values())
    assert layer.train_ports(config, max_pairs=100).u["port"][0] > 0.3
    with pytest.raises(ValueError):
        linkage.settings("port", {"general_config_algorithms": {"x": {"algorithm": "none", "thresholds": []}}, "entity_categories": {"port": {"field_l": "a", "field_r": "b", "algorithms": ["x"]}}})


def test_sampled_pairs_keep_to_their_number(spark):
    left, right = (spark.range(3000).select(F.col("id").alias("unique_id"), F.col("id").alias(c)) for c in "ab")
    n = linkage.sampled_pairs(left.select("unique_id", "a"), right.select(F.col("unique_id").alias("unique_id"), "b"), 100_000).select("a", "b").count()
    assert 50_000 < n < 200_000


def test_half_written_versions_are_not_read(spark, tmp_path):
    store = TableStore(spark, LakeConfig(base_path=str(tmp_path)))
    df = spark.createDataFrame([(1,)], "k int")
    store.write(df, "t")
    root = store.config.path("t").removeprefix("file://")
    open(f"{root}/log/0000000001.json", "w").close()
    assert store.read("t").count() == 1 and store.write(df, "t", mode="append") == 2 and store.read("t").count() == 2
    for _ in range(35):
        store.write(df, "t", mode="append")
    assert store.detail("t")["parts"] < 34 and store.read("t").count() == 37


def test_layers_by_name(spark, tmp_path):
    from tidewater.session import REGISTRY

    layer = REGISTRY.build("Cleaning", LakeConfig(base_path=str(tmp_path)), spark)
    assert layer.config.level == 1 and layer.is_started() and layer.read_entries() is None
    with pytest.raises(ValueError):
        layer.voices("none")
    with pytest.raises(ValueError):
        layer.register_view(spark.range(1))


def test_files_of_unknown_form(spark, tmp_path):
    from tidewater.sources.files import read_any

    forms = {"json": '[{"a": "1", "b": "x"}]', "csv": "A,B\n1,x\n", "xml": "<all><row><a>1</a><b>x</b></row></all>", "yaml": "- a: '1'\n  b: x\n"}
    for name, text in forms.items():
        (tmp_path / f"{name}.dat").write_text(text)
        row = read_any(spark, f"{tmp_path}/{name}.dat").first()
        assert (row["a"], row["b"]) == ("1", "x")
