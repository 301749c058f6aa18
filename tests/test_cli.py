"""Command line: job arguments and a JSON list of tables."""

import json

from tidemark.__main__ import main
from tidemark.sources.landed import read_landed


def _export(path, ids):
    path.write_text("".join(json.dumps({"Item": {"id": {"S": str(i)}, "v": {"N": str(i)}}}) + "\n" for i in ids))


def test_single_table_args(spark, tmp_path, capsys):
    src = tmp_path / "items.json"
    _export(src, [1, 2, 3])
    argv = ["--JOB_NAME", "x", "--bucket_name", str(tmp_path), "--folder_name", "landed",
            "--primary_key", "id", "--dynamo_table_name", "t", "--source", str(src), "--scheme", "file"]
    assert main(argv, spark) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["status"] == "SUCCEEDED" and report["new_rows"] == 3
    assert sorted(r["id"] for r in read_landed(spark, f"file://{tmp_path}/landed").collect()) == ["1", "2", "3"]


def test_config_list_with_a_failing_table(spark, tmp_path, capsys):
    src = tmp_path / "items.json"
    _export(src, [1])
    tables = [
        {"--bucket_name": str(tmp_path), "--folder_name": "a", "--primary_key": "id", "source": str(src)},
        {"--bucket_name": str(tmp_path), "--folder_name": "b", "--primary_key": "id,v",
         "--primary_key_is_composite": "true", "source": str(src)},
        {"--bucket_name": str(tmp_path), "--folder_name": "c", "--primary_key": "nope", "source": str(src)},
    ]
    cfg = tmp_path / "tables.json"
    cfg.write_text(json.dumps(tables))
    assert main(["--configs", str(cfg), "--scheme", "file", "--max_attempts", "1"], spark) == 1
    rows = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert [r["status"] for r in rows] == ["SUCCEEDED", "SUCCEEDED", "FAILED"]
    assert rows[1]["key_kind"] == "composite"


def test_options_and_unknown_names(spark, tmp_path):
    import pytest

    src = tmp_path / "items.json"
    _export(src, [1, 2])
    argv = ["--bucket_name", str(tmp_path), "--folder_name", "o", "--primary_key", "id", "--source", str(src), "--scheme", "file",
            "--rules", "RowCount < 1", "--fail_on_violation", "true"]
    assert main(argv, spark) == 1
    assert main([*argv[:-2], "--audit_names", "d,t"], spark) == 0
    assert {"d", "t"} <= set(read_landed(spark, f"file://{tmp_path}/o").columns)
    cfg = tmp_path / "tables.json"
    cfg.write_text(json.dumps([{"bucket_name": str(tmp_path), "folder_name": "x", "primary_key": "id", "source": str(src), "layuot": "per_key"}]))
    with pytest.raises(ValueError, match="layuot"):
        main(["--configs", str(cfg), "--scheme", "file"], spark)
