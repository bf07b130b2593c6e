import json
import os

from siltworks import cli


def test_validate(tmp_path, capsys):
    path = tmp_path / "rule.json"
    path.write_text(json.dumps({"Dest": {"Table": "d.t", "UniqueColumns": ["id"]}}))
    assert cli.main(["-r", str(path), "-V"]) == 1
    path.write_text(json.dumps({"Dest": {"Table": "d.t"}}))
    assert cli.main(["-r", str(path), "-V"]) == 0


def test_load_once(spark, tmp_path, capsys):
    spark.sql("CREATE SCHEMA IF NOT EXISTS cli")
    file = tmp_path / "in" / "a.json"
    file.parent.mkdir()
    file.write_text('{"id": 1}\n{"id": 2}\n')
    os.utime(file, (1_700_000_000, 1_700_000_000))
    for _ in range(2):
        assert cli.main(["-s", str(tmp_path / "in"), "-d", "cli.t", "-f", "json", "-j", "cli.journal"]) == 0
    assert spark.table("cli.t").count() == 2
    spark.sql("DROP SCHEMA cli CASCADE")
