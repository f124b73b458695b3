from reqlens.session import configure


def test_configure_keeps_existing_settings(spark):
    old = spark.conf.get("spark.sql.adaptive.skewJoin.enabled")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        configure(spark, checkpoint_dir="/nonexistent/should-not-be-used")
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "false"
        assert spark.sparkContext.getCheckpointDir() != "/nonexistent/should-not-be-used"
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", old)
