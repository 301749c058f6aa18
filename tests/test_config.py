import pytest

from tidemark.config import TableConfig, check_configs, parse_keys


def test_parse_keys_trims_and_splits():
    assert parse_keys("factoryAddress, splitterAddress") == ("factoryAddress", "splitterAddress")
    assert parse_keys("id") == ("id",)
    assert parse_keys(["a", " b "]) == ("a", "b")


@pytest.mark.parametrize("bad", ["", "a,,b", "a, ", "a,a", []])
def test_parse_keys_rejects(bad):
    with pytest.raises(ValueError):
        parse_keys(bad)


def test_table_config_validates():
    cfg = TableConfig("t", "/x", "a,b", "/src")
    assert cfg.keys == ("a", "b") and cfg.key_kind == "composite"
    assert TableConfig("t", "/x", "id", "/src").key_kind == "single"
    with pytest.raises(ValueError):
        TableConfig("t", "/x", "id", "/src", layout="nope")
    with pytest.raises(ValueError):
        TableConfig("t", "/x", "id", "/src", on_empty="nope")
    with pytest.raises(ValueError):
        TableConfig("t", "/x", "id", "/src", source_format="csv")
    with pytest.raises(ValueError):
        TableConfig("t", "/x", "id", "/src", audit_names=("a", "a"))


def test_check_configs_rejects_shared_root():
    a = TableConfig("a", "/root/x/", "id", "/s1")
    b = TableConfig("b", "/root/x", "id", "/s2")
    with pytest.raises(ValueError):
        check_configs([a, b])
    check_configs([a, TableConfig("c", "/root/y", "id", "/s3")])


def test_config_from_job_args():
    from tidemark.config import config_from_job_args
    args = {"--bucket_name": "b", "--catalog_database": "general", "--catalog_table_name": "T",
            "--dynamo_table_name": "T", "--folder_name": "T", "--primary_key": "account_id,contract_id",
            "--primary_key_is_composite": "true"}
    cfg = config_from_job_args(args, source="s3a://b/exports/T/")
    assert cfg.root == "s3a://b/T" and cfg.keys == ("account_id", "contract_id")
    assert cfg.key_kind == "composite" and cfg.catalog_table == "T"
    single = config_from_job_args({**args, "--primary_key": "id", "--primary_key_is_composite": "false"},
                                  source="x", scheme="file", layout="per_key")
    assert single.root == "file:///b/T" and single.layout == "per_key"
    with pytest.raises(ValueError):
        config_from_job_args({**args, "--primary_key": "id"}, source="x")
    with pytest.raises(ValueError):
        config_from_job_args({"--bucket_name": "b"}, source="x")


def test_entries_set_every_option_and_refuse_unknown_names():
    from tidemark.config import config_from_entry, parse_rule
    from tidemark.operators.quality import ColumnCount, IsComplete, RowCount

    base = {"--bucket_name": "b", "--folder_name": "t", "--primary_key": "id", "source": "s3a://b/x/"}
    cfg = config_from_entry({**base, "null_safe": "true", "layout": "per_key", "audit_names": "d,t", "fields": "id, v",
                             "on_empty": "skip", "as_text": False, "join_strategy": "shuffle", "broadcast_max_bytes": "5",
                             "rules": 'ColumnCount > 0; RowCount >= 2; IsComplete "id"', "fail_on_violation": "True",
                             "options": '{"wholetext": "false"}', "write_options": {"compression": "zstd"}})
    assert cfg.null_safe and cfg.layout == "per_key" and cfg.audit_names == ("d", "t") and cfg.fields == ("id", "v")
    assert cfg.rules == (ColumnCount(">", 0), RowCount(">=", 2), IsComplete("id")) and cfg.fail_on_violation
    assert cfg.options == {"wholetext": "false"} and cfg.write_options == {"compression": "zstd"} and cfg.broadcast_max_bytes == 5
    for wrong in ({"layuot": "per_key"}, {"null_safe": "yes"}, {"rules": "Rows > 0"}, {"source": ""}):
        with pytest.raises(ValueError):
            config_from_entry({**base, **wrong})
    assert parse_rule(IsComplete("x")) == IsComplete("x")


def test_roots_by_any_spelling():
    from tidemark.config import normal_root

    assert normal_root("/q/") == normal_root("file:///q") == normal_root("file:/q//") == "/q"
    assert normal_root("S3A://Bucket/a//b/") == "s3a://bucket/a/b"
    with pytest.raises(ValueError, match="share"):
        check_configs([TableConfig("a", "s3a://b/n", "id", "/s"), TableConfig("b", "s3a://b/n/sub", "id", "/s")])
    check_configs([TableConfig("a", "s3a://b/n", "id", "/s"), TableConfig("b", "s3a://b/nsub", "id", "/s")])
