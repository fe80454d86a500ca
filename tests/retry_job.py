"""Run in a subprocess by test_retry.py: a session that retries tasks, and a
client that kills its Python worker on each task's first attempt."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from parley.config import SizeLimits  # noqa: E402
from parley.plans import stand_ins  # noqa: E402
from parley.plans import pipeline  # noqa: E402
from parley.session import build_session  # noqa: E402
from parley.sources import tables  # noqa: E402


class DiesOnFirstAttempt(stand_ins.EchoClient):
    def __call__(self, payload):
        from pyspark import TaskContext
        ctx = TaskContext.get()
        if ctx is not None and ctx.attemptNumber() == 0:
            os._exit(3)            # the worker process is gone, not an exception
        return super().__call__(payload)


def main() -> None:
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark = build_session(master="local[4,3]", shuffle_partitions=4)
    conv = tables.read_table(spark, sys.argv[1], "conversations").repartition(3)
    lim = SizeLimits(max_payload_bytes=2048)
    flaky = pipeline.transcribe_calls(conv, DiesOnFirstAttempt(1800), limits=lim, run_ts="2024-01-01 00:00:00")
    clean = pipeline.transcribe_calls(conv, stand_ins.EchoClient(1800), limits=lim, run_ts="2024-01-01 00:00:00")
    a = sorted(map(tuple, flaky.collect()))
    b = sorted(map(tuple, clean.collect()))
    print(json.dumps({"rows": len(a), "equal": a == b}))


if __name__ == "__main__":
    main()
