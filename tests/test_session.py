"""The checkpoint folder is read from the session; a local one only when unset."""

from quire.session import DEFAULT_CONF, ensure_checkpoint_dir


def test_existing_checkpoint_dir_is_kept(spark):
    before = spark.sparkContext.getCheckpointDir()
    assert before  # set by the test session fixture
    assert ensure_checkpoint_dir(spark) == before
    assert spark.sparkContext.getCheckpointDir() == before


def test_session_defaults_keep_the_ui_off_and_aqe_on(spark):
    assert DEFAULT_CONF["spark.ui.enabled"] == "false"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
