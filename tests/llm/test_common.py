import re
import sys

import numpy as np
import pytest

from kinora.llm import common


def held_mb():
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"\nPss_Anon:\s+(\d+)", f.read())[1]) / 1024


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_a_worker_gives_back_what_a_task_has_freed():
    """Small arrays below one that stays keep their pages, unless these are released."""
    pinned = []

    def run(batches):
        for batch in batches:
            own = [np.ones(8_000) for _ in range(3_000)]  # 190 MB, below the size that is mapped by itself
            pinned.append(np.ones(8_000))
            yield batch, len(own)
    before = held_mb()
    assert list(run(iter("a"))) == [("a", 3_000)]
    kept = held_mb() - before
    assert list(common.released(run)(iter("a"))) == [("a", 3_000)]
    assert kept > 100 and held_mb() - before < 50
