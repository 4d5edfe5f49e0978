import pyarrow as pa

from polyad.llm.common import map_batches, tidy, worker_memory


class Big:
    made = 0

    def __init__(self):
        Big.made += 1


def task(owner):
    """Runs a task of one owner; how many objects have been made by then."""

    def use(batches):
        worker_memory("big", Big)
        yield from batches

    list(tidy(use, owner)(iter([pa.record_batch({"x": [1]})])))
    return Big.made


def test_what_a_worker_remembers_goes_with_the_first_task_of_another_owner():
    assert [task("a"), task("a"), task("b"), task("b"), task("a")] == [1, 1, 2, 2, 3]


def test_rows_of_a_function_belong_to_its_module(spark):
    """A worker that encoded texts does not keep their words while other stages run."""

    def remembered(source):
        import sys

        held = sys.modules["_polyad_llm_memory"].__dict__
        for _ in source:
            yield [[f"{held['owner']} {sorted(held.get('held', {}))}"]]

    def use(source):
        worker_memory("own", list)
        yield from remembered(source)

    use.__module__, remembered.__module__ = "one", "two"
    rows = spark.range(1).repartition(1)
    first = [r.x for r in map_batches(rows, use, "x string").collect()]
    assert first == ["one ['own']"]
    assert [r.x for r in map_batches(rows, remembered, "x string").collect()] == ["two []"]
