from forgestat.__main__ import main


def test_cli_publish(spark, capsys):
    main(["publish", "--sf-dir", "/root/testdata/sf0.001", "--marts-db", "cli_marts", "--intermediate-db", "cli_int"])
    out = capsys.readouterr().out
    assert "cli_marts.fct_pull_requests" in out
    assert spark.table("cli_marts.dim_users").count() > 0
    assert spark.table("cli_int.int_contributor_activity").count() > 0
