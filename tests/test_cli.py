from sublens.__main__ import main


def test_cli_prints_the_report(spark, capsys):
    main(["--sources", "/root/testdata/sf0.001", "--today", "2024-01-31", "--driver-tables"])
    lines = capsys.readouterr().out.strip().splitlines()
    assert len(lines) >= 38
    assert lines[0].startswith("2024-01-30\t1\tNew Monthly Free Trialists\t")
