from martloom import __main__ as cli
from martloom.operators import versions


def test_history_and_restore(spark, fresh, capsys):
    versions.publish(spark.range(3), fresh, "load")
    versions.publish(spark.range(5), fresh, "load")
    cli.main(["restore", fresh, "1"])
    cli.main(["history", fresh])
    assert "restore of 1" in capsys.readouterr().out
    assert versions.read(spark, fresh).count() == 3
