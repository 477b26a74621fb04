"""Rules the library keeps so that it runs on a cluster."""

from pathlib import Path

SOURCE = [p for p in (Path(__file__).parent.parent / "cloakwork").rglob("*.py")]


def test_no_cross_joins_or_machine_local_state():
    for path in SOURCE:
        text = path.read_text()
        for word in ("crossJoin", "localCheckpoint", ".rdd", "toLocalIterator"):
            assert word not in text, (path, word)


def test_task_functions_travel_with_the_job():
    """Workers need not find the package: its functions are pickled by value."""
    import cloakwork
    from pyspark import cloudpickle

    assert cloakwork.__name__ in cloudpickle.list_registry_pickle_by_value()
