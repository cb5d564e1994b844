"""Session helper: setting precedence on a reused session, checkpoint folder."""

from strata.session import SCALE_CONF, build_session, checkpoint_dir


def test_scale_profile_and_explicit_precedence(spark):
    before = {k: spark.conf.get(k) for k in SCALE_CONF}
    try:
        s = build_session(scale=True, shuffle_partitions=3,
                          extra={"spark.sql.warehouse.dir": "/nowhere"})   # static: not re-applied
        assert s is spark
        assert s.conf.get("spark.sql.shuffle.partitions") == "3"          # explicit wins over the profile
        assert s.conf.get("spark.sql.files.maxPartitionBytes") == SCALE_CONF["spark.sql.files.maxPartitionBytes"]
        assert s.conf.get("spark.sql.session.timeZone") == "UTC"
        assert s.conf.get("spark.sql.warehouse.dir") != "/nowhere"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_checkpoint_dir_is_the_sessions(spark):
    d = checkpoint_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir()
    assert checkpoint_dir(spark) == d
