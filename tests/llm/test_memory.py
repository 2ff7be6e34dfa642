import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_a_worker_gives_back_what_a_task_needed():
    code = """
from shelf.llm.common import lean
held = lambda: int(open('/proc/self/statm').read().split()[1]) * 4096
pins = []
def run(batches):
    for b in batches:
        needed = [bytes(1000) for _ in range(100_000)]
        pins.append(bytes(1000))  # lies above them, so that the heap can't shrink by itself
        yield b
before = held()
assert list(lean(run)(iter([1, 2]))) == [1, 2]
print(held() - before < 30_000_000)"""
    assert subprocess.run([sys.executable, "-B", "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=60).stdout.strip() == "True"


def test_workers_of_the_near_duplicate_stage_do_without_pandas():
    code = "import shelf.llm.toxicity, shelf.llm.simhash, sys; print('pandas' in sys.modules)"
    assert subprocess.run([sys.executable, "-B", "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=60).stdout.strip() == "False"


def test_a_worker_keeps_no_vocabulary_after_its_task():
    import gc
    import weakref

    from shelf.llm import bpe

    held = weakref.ref(bpe.load_byte_bpe(bpe.default_path()))
    gc.collect()
    assert held() is None
