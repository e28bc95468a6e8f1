import pytest

from tallygrid.session import SETTINGS, session, sized_for


@pytest.mark.parametrize("size,partitions,piece", [
    (1 << 30, 200, 128 << 20), (1 << 40, 2048, 128 << 20), (100 << 40, 204_800, 128 << 20)])
def test_sizes_grow_with_the_input_without_bound(size, partitions, piece):
    found = sized_for(size)
    assert int(found["spark.sql.shuffle.partitions"]) == partitions
    assert int(found["spark.sql.files.maxPartitionBytes"]) == piece


def test_session_has_the_settings(spark):
    again = session("again", settings={"spark.sql.shuffle.partitions": "4"})
    assert all(again.conf.get(name) == value for name, value in SETTINGS.items())
