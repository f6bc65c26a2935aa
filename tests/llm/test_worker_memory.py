"""What a task has freed goes back to the system when it ends: idle Python workers stay small."""

import os

import public_tokenizers

from nestflow.llm import tokens
from nestflow.llm.common import in_arrow


def resident_mb():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 1e6


def test_memory_goes_back_at_a_task_end(spark):
    pinned = []

    class Frame:
        """Gives the function that a task would run."""
        sparkSession = spark

        def mapInArrow(self, function, schema):
            return function

    def work(found):
        held = [bytearray(4000) for _ in range(100_000)]
        pinned.append(bytearray(4000))  # keeps the end of the heap in use
        yield len(held)

    task = in_arrow(Frame(), work, "n long")
    before = resident_mb()
    assert list(task(iter([]))) == [100_000]
    assert resident_mb() - before < 100


def test_encoders_are_forgotten():
    path = public_tokenizers.path("word_bpe_49k.json")
    first = tokens.encoder(path)
    assert tokens.encoder(path) is first
    tokens.forget_encoders()
    assert tokens.encoder(path) is not first
