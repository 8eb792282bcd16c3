from __future__ import annotations

import gc
import re
import time
from pathlib import Path

import pytest

from strandlake.runtime import release


def anonymous_mb(pid):
    return int(re.search(r"\nAnonymous:\s+(\d+)", Path(f"/proc/{pid}/smaps_rollup").read_text())[1]) / 1024


def test_release_hands_back_native_memory_of_the_driver(spark):
    jvm = spark.sparkContext._jvm
    pid = int(jvm.java.lang.management.ManagementFactory.getRuntimeMXBean().getName().split("@")[0])
    if not Path(f"/proc/{pid}/smaps_rollup").exists():
        pytest.skip("memory can't be read here")
    release(spark)
    buffers = [jvm.java.nio.ByteBuffer.allocateDirect(100_000) for _ in range(3000)]
    last = buffers[-1]  # in use still, above all that is freed
    del buffers
    gc.collect()
    for _ in range(3):
        jvm.System.gc()
        time.sleep(0.5)
    freed = anonymous_mb(pid)
    release(spark)
    assert last.capacity() == 100_000 and freed - anonymous_mb(pid) > 100
