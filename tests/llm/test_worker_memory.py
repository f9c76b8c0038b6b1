import os

from tidemark.llm import worker_memory


def resident_mb():
    with open("/proc/self/statm") as file:
        return int(file.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 1e6


def blocks():
    """Memory that cannot fall off the end of the heap, since its last block stays in use."""
    held = [bytes(2_000) for _ in range(100_000)]
    return held, held[-1]


def test_what_a_task_has_freed_goes_back_to_the_system():
    held, last = blocks()
    full = resident_mb()

    def run(batches):
        held.clear()
        yield from batches

    assert list(worker_memory.frugal(run)([1, 2])) == [1, 2]
    assert resident_mb() < full - 150 and last


def test_what_is_dropped_for_another_operator_goes_back_too():
    last = worker_memory.remembered("words", blocks)[1]
    full = resident_mb()
    assert worker_memory.remembered("others", list) == []
    assert resident_mb() < full - 150 and last
    worker_memory.forget()
