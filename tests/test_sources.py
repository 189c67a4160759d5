from __future__ import annotations

from types import SimpleNamespace

import pytest

from portolan.sources import (
    OTHER_STATE,
    STATE_CODES,
    TRAVEL_MODES,
    VISA_PURPOSES,
    code_list,
    ensure_checkpoint_dir,
    materialize_if_missing,
    new_scratch_path,
    read_code_list,
    read_delimited,
    read_format_statement,
    read_parquet,
    read_table,
    write_partitioned,
    write_table,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_read_delimited(spark, tmp_path):
    (tmp_path / "a.csv").write_text('City;Median Age;Count\nSilver Spring;33.8;21330\n"A; B";;x\n')
    df = read_delimited(spark, str(tmp_path / "a.csv"), sep=";", required=["Count", "City"])
    assert set(dict(df.dtypes).values()) == {"string"}
    assert rows(df) == [("A; B", None, "x"), ("Silver Spring", "33.8", "21330")]
    with pytest.raises(ValueError, match="Race"):
        read_delimited(spark, str(tmp_path / "a.csv"), sep=";", required=["Race"])


def test_files_of_a_folder_must_agree(spark, tmp_path):
    for name, header in (("x", "a,b"), ("y", "b,a")):
        (tmp_path / f"{name}.csv").write_text(f"{header}\n1,2\n")
    with pytest.raises(Exception, match="header|schema"):
        read_delimited(spark, str(tmp_path)).select("b").collect()
    with pytest.raises(Exception, match="header|schema"):
        read_code_list(spark, str(tmp_path), "code", "name").collect()
    (tmp_path / "y.csv").write_text("a,b\n3,4\n")
    assert rows(read_delimited(spark, str(tmp_path))) == [("1", "2"), ("3", "4")]


def test_short_write_leaves_the_old_table(spark, small, tmp_path, monkeypatch):
    from portolan import schema
    from portolan.operators import QualityError
    from portolan.plans import job, modes_dimension

    modes = modes_dimension(spark)
    assert job.publish(modes, schema.MODES, str(tmp_path)).count() == 4
    monkeypatch.setattr(job, "write_table", lambda df, path: write_table(df.limit(2), path))
    with pytest.raises(QualityError, match="source's rows"):
        job.publish(modes, schema.MODES, str(tmp_path))
    assert read_table(spark, str(tmp_path / schema.MODES.folder)).count() == 4


def test_read_parquet(spark, small, tmp_path):
    write_table(small("nation"), str(tmp_path / "n"))
    df = read_parquet(spark, str(tmp_path / "n"), small("nation").schema, ["n_name"])
    assert df.count() == 25
    with pytest.raises(ValueError):
        read_parquet(spark, str(tmp_path / "n"), required=["absent"])


def test_partitioned_write_and_month_rerun(spark, tmp_path):
    path = str(tmp_path / "fact")
    first = spark.createDataFrame([(1, 2016, 4), (2, 2016, 5), (3, 2016, 5)], "id int, y int, m int")
    write_partitioned(first, path, ["y", "m"])
    assert sorted(p.name for p in (tmp_path / "fact" / "y=2016").iterdir()) == ["m=4", "m=5"]
    again = spark.createDataFrame([(9, 2016, 5)], "id int, y int, m int")
    write_partitioned(again, path, ["y", "m"], only_present=True)
    assert rows(spark.read.parquet(path)) == [(1, 2016, 4), (9, 2016, 5)]
    write_partitioned(again, path, ["y", "m"])
    assert rows(spark.read.parquet(path)) == [(9, 2016, 5)]


def test_large_partition_is_written_by_several_tasks(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "64KB")
    try:
        df = spark.range(200_000).selectExpr("id", "if(id % 100 = 0, 1, 2) AS m")
        write_partitioned(df.repartition(8), str(tmp_path / "t"), ["m"])
    finally:
        spark.conf.set(size, before)
    files = {m: len(list((tmp_path / "t" / f"m={m}").glob("*.parquet"))) for m in (1, 2)}
    assert files[2] > 1 and files[1] <= 2
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000


def test_materialize_if_missing(spark, tmp_path):
    path, built = str(tmp_path / "copy"), []

    def build():
        built.append(1)
        return spark.range(3)

    assert materialize_if_missing(spark, path, build).count() == 3
    assert materialize_if_missing(spark, path, build).count() == 3
    assert built == [1]
    (tmp_path / "broken").mkdir()
    assert materialize_if_missing(spark, str(tmp_path / "broken"), build).count() == 3
    with pytest.raises(ZeroDivisionError):
        materialize_if_missing(spark, str(tmp_path / "other"), lambda: 1 / 0)
    # An interrupted write: some data, no mark of its end.
    spark.range(10).repartition(4).write.parquet(str(tmp_path / "half"))
    next((tmp_path / "half").glob("part-*.parquet")).unlink()
    (tmp_path / "half" / "_SUCCESS").unlink()
    assert materialize_if_missing(spark, str(tmp_path / "half"), build).count() == 3


def test_code_lists(spark, tmp_path):
    assert rows(code_list(spark, VISA_PURPOSES, "code", "name")) == [(1, "Business"), (2, "Pleasure"), (3, "Student")]
    assert len(TRAVEL_MODES) == 4 and TRAVEL_MODES[9] == "Not reported"
    assert len(STATE_CODES) == len(set(STATE_CODES)) == 54 and OTHER_STATE not in STATE_CODES
    (tmp_path / "ports.csv").write_text('code,name\nCP ,"No PORT Code (CP)"\nNOM,"NOM, AK   "\n')
    listed = read_code_list(spark, str(tmp_path / "ports.csv"), "code", "port_name")
    assert rows(listed) == [("CP ", "No PORT Code (CP)"), ("NOM", "NOM, AK   ")]


def test_format_statement(spark, tmp_path):
    (tmp_path / "labels.sas").write_text(
        "libname library 'x' ;\nproc format library=library ;\n"
        "/* first list, 1 = Business */\n  value cntry\n   582 =  'MEXICO (I-94, no land)'\n"
        "   687 =  'ARGENTINA '\n     0 = 'INVALID: STATELESS' ;\n\n"
        "/* second */\n  value $port\n   'ALC'\t=\t'ALCAN, AK   '\n   'CP '=\t'No Code (CP)'\n"
        "   'INT' = 'INT''L FALLS, MN'\n;\nvalue cntry2\n 1 = 'x' ;\nrun ;\n"
    )
    path = str(tmp_path / "labels.sas")
    countries = read_format_statement(spark, path, "cntry", "code", "name", "int")
    assert dict(countries.dtypes) == {"code": "int", "name": "string"}
    assert rows(countries) == [(0, "INVALID: STATELESS"), (582, "MEXICO (I-94, no land)"), (687, "ARGENTINA ")]
    ports = read_format_statement(spark, path, "port", "code", "name")
    assert rows(ports) == [("ALC", "ALCAN, AK   "), ("CP ", "No Code (CP)"), ("INT", "INTL FALLS, MN")]


class StandIn:
    """As much of a session as the scratch folder looks at."""

    def __init__(self, master, setting=None):
        self.folder = None
        self.conf = SimpleNamespace(get=lambda key, default: setting or default)
        self.sparkContext = SimpleNamespace(
            master=master,
            getCheckpointDir=lambda: self.folder,
            setCheckpointDir=lambda path: setattr(self, "folder", path),
        )


def test_scratch_folder_without_a_setting():
    local = StandIn("local[4]")
    folder = ensure_checkpoint_dir(local)
    assert folder and ensure_checkpoint_dir(local) == folder
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(StandIn("yarn"))
    assert ensure_checkpoint_dir(StandIn("yarn", "hdfs:/shared")) == "hdfs:/shared"


def test_scratch_folder_follows_the_session(spark):
    configured = ensure_checkpoint_dir(spark)
    assert spark.conf.get("spark.checkpoint.dir", configured) == configured
    first, second = new_scratch_path(spark, "x"), new_scratch_path(spark, "x")
    assert first != second and first.startswith(configured.rstrip("/"))
