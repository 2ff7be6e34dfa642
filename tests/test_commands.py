import json
import zipfile

import pytest

from shelf import commands
from shelf.operators.exports import Options
from shelf.settings import Settings, dump_settings, settings_from
from tests.test_sources import BOOK, many


def insert(table, columns, rows):
    body = ",".join("(" + ",".join("NULL" if v is None else str(v) if isinstance(v, int) else f"'{v}'" for v in r) + ")" for r in rows)
    declared = ",\n".join(f"  `{c}` text" for c in columns)
    return f"CREATE TABLE `{table}` (\n{declared}\n) ENGINE=InnoDB;\nINSERT INTO `{table}` VALUES {body};\n-- Dump completed on 2026-06-22  1:02:03\n"


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("world")
    (root / "zips").mkdir()
    (root / "sql").mkdir()
    with zipfile.ZipFile(root / "zips" / "fb2-1-9.zip", "w") as z:
        z.writestr("1.fb2", BOOK % many(120))
        z.writestr("named.fb2", BOOK % "")
        z.writestr("x.txt", "x")
        z.writestr("old.org", "backup")
        z.writestr("9.fb2", "broken")
    tables = {
        "libbook": (["BookId", "FileSize", "Title", "Lang", "FileType", "Deleted", "keywords"], [(1, 10, "Db one", "RU", "fb2", "0", "k"), (5, 20, "Db five", "??", "fb2", "0", ""), (7, 1, "No file", "ru", "fb2", "0", "")]),
        "libavtor": (["BookId", "AvtorId", "Pos"], [(1, 10, 0), (5, 11, 0)]),
        "libavtorname": (["AvtorId", "FirstName", "MiddleName", "LastName", "NickName"], [(10, "Ann", "", "Lee", "al"), (11, "Ann", "", "Lee", "")]),
        "libfilename": (["BookId", "FileName"], [(5, "named.fb2")]),
        "libseq": (["BookId", "SeqId", "SeqNumb", "Level", "Type"], [(1, 40, 3, 1, 0)]), "libseqname": (["SeqId", "SeqName"], [(40, "Cycle")]),
    }
    for name, (columns, rows) in tables.items():
        (root / "sql" / f"{name}.sql").write_text(insert(name, columns, rows))
    cache, settings = commands.Cache(str(root / "cache")), Settings(library="lib", parse="fingerprint", content_hash=True)
    assert commands.build_cache(spark, cache, settings, str(root / "zips"), str(root / "sql")) == commands.DONE
    return root, cache, settings


def test_merge_and_checks(spark, world):
    _, cache, settings = world
    dataset = commands.merge(spark, cache, settings)
    assert dataset.header["records"] == 3 and [(a["id"], a["entries"], a["fb2_entries"]) for a in dataset.header["archives"]] == [("archive-0001", 5, 3)]
    assert commands.check_dataset(dataset) == []
    found = commands.inspect(dataset, book_id=5).collect()
    assert len(found) == 1 and found[0].locator['index'] == 1 and found[0].match.method == "filename_alias"
    assert commands.inspect(dataset, file="9.FB2").first().issues[0].stage == "parse"
    assert commands.inspect(dataset, book_id=7).collect() == []
    assert tuple(commands.inspect(dataset).first())[:3] == (3, 2, 2)


def test_exports(spark, world, tmp_path):
    _, cache, settings = world
    dataset = commands.merge(spark, cache, settings)
    lines = {r["index"]: r.line.split("\x04") for r in commands.export(dataset, settings, "multi-series", Options(source_library="lib")).collect()}
    assert lines[0][0] == "Lee [al],Ann,:" and lines[0][2:5] == ["Db one", "Cycle", "3"] and lines[0][11] == "ru"
    assert lines[1][0] == "Lee [#11],Ann,:" and lines[1][11] == "en" and set(lines) == {0, 1}
    positional = commands.export(dataset, settings, "positional")
    assert sorted(r["index"] for r in positional.collect()) == [0, 1, 2, 4] and positional.where("is_dummy").count() == 2
    cut = commands.export(dataset, settings, "slice", where="lib_id = '5'", split_by="range_name(lib_id, 10, 'x')")
    target = str(tmp_path / "out.zip")
    commands.write_export(cut, target, settings, "20260622")
    with zipfile.ZipFile(target) as z:
        assert sorted(z.namelist()) == ["0000000001-0000000010.inp", "collection.info", "version.info"]
    with pytest.raises(ValueError):
        commands.export(dataset, settings, "other")


def test_only_changed_archives_are_scanned_again(spark, world):
    root, cache, settings = world
    decisions = {r.archive: r.decision for r in commands.archive_decisions(spark, str(root / "zips"), cache, settings).collect()}
    assert decisions == {"fb2-1-9.zip": "use"}
    other = Settings(library="lib", parse="title")
    assert {r.decision for r in commands.archive_decisions(spark, str(root / "zips"), cache, other).collect()} == {"none"}
    assert commands.build_cache(spark, cache, other, str(root / "zips")) == commands.NOT_READY


def test_a_catalogue_alone(spark, world, tmp_path):
    root, _, settings = world
    cache = commands.Cache(str(tmp_path / "cache"))
    commands.build_cache(spark, cache, settings, None, str(root / "sql"))
    dataset = commands.merge(spark, cache, settings)
    assert dataset.header["records"] == 3 and dataset.header["ordering"]["mode"] == "database_book" and commands.check_dataset(dataset) == []
    assert {r.archive for r in commands.export(dataset, settings, "multi-series").collect()} == {"online"}


def test_rollup_plan(spark):
    make = lambda rows: spark.createDataFrame(rows, "archive string, book_id long, size long")
    plan, code = commands.plan_rollup(make([("f", 100, 1)]), make([("m", 101, 40)]), make([("u", 50, 1), ("u", 101, 9), ("u", 102, 70), ("u", 103, 5)]), Settings(rollup_bytes=100))
    assert code == commands.NEW and [tuple(r) for r in plan.orderBy("bin").select("begin", "end", "finalised").collect()] == [(102, 102, True), (103, 103, False)]


def test_settings_are_strict():
    assert settings_from(json.loads(dump_settings(Settings()))) == Settings()
    for bad in ({"x": 1}, {"language": {"y": 1}}, {"parse": "all"}, {"compression": "rar"}, {"rollup_bytes": 0}):
        with pytest.raises(ValueError):
            settings_from(bad)


def run(capsys, *args):
    from shelf.__main__ import main

    code = main([str(a) for a in args])
    return code, capsys.readouterr().out.strip().splitlines()


def test_command_line(spark, world, tmp_path, capsys):
    root, cache, _ = world
    config = tmp_path / "config.json"
    config.write_text(json.dumps({"library": "lib", "parse": "fingerprint", "content_hash": True, "compression": "gz"}))
    where = tmp_path / "where.sql"
    where.write_text("lib_id = '1'\n")
    base = ["--config", config]
    assert run(capsys, *base, "cache", "--cache", cache.root, "--archives", root / "zips", "--check-md5") == (commands.DONE, [])
    code, lines = run(capsys, *base, "inspect", "--cache", cache.root, "--archives")
    assert code == 0 and json.loads(lines[0])["ignored"] == [{"start": 3, "end": 3}] and json.loads(lines[0])["dummy"] == [{"start": 2, "end": 2}]
    code, lines = run(capsys, *base, "inspect", "--cache", cache.root, "--ambiguous-authors")
    assert code == 0 and json.loads(lines[0])["authors"] == ["10", "11"]
    code, lines = run(capsys, *base, "inspect", "--cache", cache.root, "--file", "1.fb2", "--decode-fp")
    assert code == 0 and json.loads(lines[0])["depth"] == 0 and len(json.loads(lines[0])["key_hex"]) == 32
    assert run(capsys, *base, "inspect", "--cache", cache.root, "--validate") == (0, ["valid"])
    assert run(capsys, *base, "inspect", "--cache", cache.root, "--book-id", 77)[0] == commands.NO_MATCH
    code, lines = run(capsys, *base, "merge", "--cache", cache.root, "--archives", root / "zips", "--output", tmp_path / "all", "--dump-date", "20260622")
    assert code == 0 and lines == [str(tmp_path / "all.jsonl.gz")]
    import gzip

    rows = [json.loads(x) for x in gzip.open(lines[0], "rt").read().splitlines()]
    assert rows[0]["records"] == len(rows) - 1 == 3 and rows[0]["id"].startswith("urn:uuid:") and rows[0]["database"]["dumps"][0]["name"] == "libavtor.sql" and [r["locator"]["index"] for r in rows[1:]] == [0, 1, 4]
    target = tmp_path / "out.zip"
    assert run(capsys, *base, "export", "--cache", cache.root, "--output", target, "--dump-date", "20260622", "--where-file", where, "--additional")[0] == 0
    with zipfile.ZipFile(tmp_path / "out_20260622.zip") as z:
        assert sorted(z.namelist()) == ["archive-0001.inp", "collection.info", "structure.info", "version.info"] and z.read("archive-0001.inp").count(b"\r\n") == 1 and z.comment == b"lib_20260622"
    assert run(capsys, *base, "export", "--cache", cache.root, "--layout", "positional", "--format", "ruks", "--output", target, "--dump-date", "20260623")[0] == 0
    with zipfile.ZipFile(tmp_path / "out_20260623.zip") as z:
        lines = z.read("archive-0001.inp").decode().splitlines()
        assert len(lines) == 4 and len(lines[0].split("\x04")) == 17 and lines[2].startswith("dummy:\x04other:\x04dummy record") and lines[3].split("\x04")[7] == "5"
    with zipfile.ZipFile(root / "zips" / "fb2-1-9.zip") as z:
        assert len(z.namelist()) == 5


def test_fetch_and_rollup_commands(spark, tmp_path, capsys):
    for folder, ids in (("done/fb2-1-3.zip", (1, 2, 3)), ("new/u1.zip", (3, 5)), ("new/u2.zip", (5, 6))):
        (tmp_path / folder).parent.mkdir(exist_ok=True)
        with zipfile.ZipFile(tmp_path / folder, "w") as z:
            for i in ids:
                z.writestr(f"{i}.fb2", "x" * 10)
            z.writestr("8.fb2", "") if "new" in folder else None
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "index.html").write_text('<a href="x/fb2-1-3.zip">a</a> <a href="x/fb2-4-9.zip">b</a>')
    code, lines = run(capsys, "fetch", "--pages", tmp_path / "pages", "--archives", tmp_path / "done")
    assert code == 0 and [json.loads(x) for x in lines] == [{"link": "x/fb2-4-9.zip", "begin": 4, "end": 9}]
    config = tmp_path / "config.json"
    config.write_text(json.dumps({"rollup_bytes": 45}))
    code, lines = run(capsys, "--config", config, "rollup", "--finalised", tmp_path / "done", "--updates", tmp_path / "new")
    assert code == commands.NEW and [(json.loads(x)["begin"], json.loads(x)["end"], json.loads(x)["bytes"]) for x in lines] == [(1, 6, 50)]
