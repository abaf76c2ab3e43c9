"""Memory helpers of the text operators."""

import pyarrow as pa

from barlake.llm import common


def _resident_mb():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096 / 1e6


def test_released_gives_memory_back():
    pinned = []

    def run(batches):
        held = [bytes(2_000) for _ in range(100_000)]  # 200 MB in pieces of the C library's heap
        pinned.append(bytes(2_000))  # above them: the heap does not shrink by itself
        yield from batches
        del held

    task = common.released(run)(iter([1, 2]))
    assert next(task) == 1
    full = _resident_mb()
    assert list(task) == [2]
    assert full - _resident_mb() > 150


def test_released_after_an_error():
    def run(batches):
        yield from (1 // x for x in batches)

    task = common.released(run)(iter([1, 0]))
    assert next(task) == 1
    try:
        next(task)
    except ZeroDivisionError:
        return
    raise AssertionError


def test_one_block_of_strings_at_a_time():
    """A batch is turned to strings block by block."""
    sizes = [len(t) for _, _, t in common.text_blocks(pa.array(["x" * 10] * 1_000), 100)]
    assert sum(sizes) == 1_000 and max(sizes) == 10
