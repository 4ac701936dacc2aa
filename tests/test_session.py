"""Session defaults yield to what the session already sets."""

from sheetlake.session import DEFAULT_SQL_CONF, checkpoint_dir, get_spark


def test_existing_values_win_and_explicit_values_apply(spark):
    key = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "1048576")
        same = get_spark()
        assert same.conf.get(key) == "1048576"                     # cluster/session value kept
        get_spark(conf={key: "2097152"})
        assert spark.conf.get(key) == "2097152"                    # explicit value applies
    finally:
        spark.conf.set(key, before)


def test_defaults_present_and_checkpoint_dir_set(spark):
    for key in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled"):
        assert spark.conf.get(key) == DEFAULT_SQL_CONF[key]
    assert checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")
