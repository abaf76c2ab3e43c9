import pytest

from barlake.__main__ import _parser, main
from barlake.session import SCALE_DEFAULTS


@pytest.fixture(autouse=True)
def _restore_settings(spark):
    """The command line tunes the session for a cluster; give the next tests theirs back."""
    before = {k: spark.conf.get(k, None) for k in SCALE_DEFAULTS}
    yield
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_parser_accepts_reference_style_arguments():
    args = _parser().parse_args(
        ["bronze-bars", "--root", "/x", "--landing", "/l", "--ticker", "AAA", "BBB", "--since", "2024-01-01"]
    )
    assert args.ticker == ["AAA", "BBB"] and args.since == "2024-01-01"


def test_missing_range_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        main(["gold-metrics", "--root", str(tmp_path / "lake")])


def test_incremental_ingest_command(spark, tmp_path):
    from barlake import testdata as td
    from barlake.sources import Lake

    landing = str(tmp_path / "landing")
    td.vendor_bars(td.table(spark, "/root/testdata/sf0.001", "events")).write.parquet(landing)
    root = str(tmp_path / "lake")
    main(["ingest-bars", "--root", root, "--landing", landing])
    main(["ingest-bars", "--root", root, "--landing", landing])  # nothing new: no second load
    assert Lake(spark, root).create().scan("bronze", "market_data_1m").count() == 1000
