"""A fallback that workers run: clients in tasks, with retries, a limit of calls and a log of answers.

Requests are dealt to ``clients`` by their id, and each client's requests are one task's, so
at most that many calls run at a time; each client keeps to its share of
``calls_per_second``. A call that raises is tried again, ``attempts`` times in all, after waits that
double; the client asks other requests meanwhile, and only with ``WAITING`` of them due for another call it sits a wait
out. A request that fails each time has no answer, which the extraction reports as such.

Answers go to a log in a shared folder as they come, ``log_every`` at a time, in a file that
appears when it is whole. A task that starts again, or a later run with the same log, reads
its client's part of the log first and asks only what is not answered there. So an answer
is asked for once, but for the up to ``log_every`` calls whose answers were not logged when an
executor was lost.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.operators.fallback import Fallback
from docsift.session import Scratch
from docsift.sources.ledger import file_system

WAITING = 1000          # requests that a client holds for their next call
LOG = "request_id string, response_json string, attempts int"
_LOG = pa.schema([("request_id", pa.string()), ("response_json", pa.string()), ("attempts", pa.int32())])


def _logged(folder: str) -> set[str]:
    """The request ids that a client's part of the log answers; those that failed are asked again."""
    from pyarrow import fs as afs

    system, inner, _ = file_system(folder)
    done: set[str] = set()
    if system.get_file_info(inner).type == afs.FileType.Directory:
        for f in system.get_file_info(afs.FileSelector(inner)):
            if f.base_name.endswith(".parquet") and not f.base_name.startswith("_"):
                answers = pq.read_table(f.path, filesystem=system).select(["request_id", "response_json"])
                done.update(answers.drop_null()["request_id"].to_pylist())
    return done


def _log(folder: str, answers: list[tuple[str, str, int]]) -> None:
    system, inner, _ = file_system(folder)
    system.create_dir(inner, recursive=True)
    name = hashlib.sha256("\n".join(a[0] for a in answers).encode()).hexdigest()[:32]
    table = pa.table([pa.array(c, t) for c, t in zip(zip(*answers), _LOG.types)], schema=_LOG)
    pq.write_table(table, f"{inner}/_{name}.part", filesystem=system)
    system.move(f"{inner}/_{name}.part", f"{inner}/{name}.parquet")


def _asked(answer: Callable[[dict], str | None], requests: Iterable[tuple[str, dict]], attempts: int, wait: float,
           pace: Callable[[], None]) -> Iterator[tuple[str, tuple[str, str | None, int]]]:
    """For ``(folder, request)``: folder and (request id, response, calls made), in the order they are done with; the
    response is None where every call failed.

    One call at a time. A request that waits for its next call holds up no other one, except others of its id:
    these are asked one after another.
    """
    waiting: list[tuple] = []               # time of the next call, a number, calls made, folder, request
    behind: dict[str, deque] = {}           # ids that wait, and what else came under them
    numbers, n_behind = itertools.count(), 0

    def called(folder: str, request: dict, calls: int) -> Iterator[tuple[str, tuple[str, str | None, int]]]:
        nonlocal n_behind
        key = request["request_id"]
        while True:
            pace()
            try:
                response = answer(request)
            except Exception:  # noqa: BLE001 - whatever the client raises, the call failed
                if calls < attempts:
                    due = time.monotonic() + wait * 2 ** (calls - 1)
                    heapq.heappush(waiting, (due, next(numbers), calls, folder, request))
                    behind.setdefault(key, deque())
                    return
                response = None
            yield folder, (key, response, calls)
            if not behind.get(key):
                behind.pop(key, None)
                return
            (folder, request), calls = behind[key].popleft(), 1
            n_behind -= 1

    def again(most: int) -> Iterator[tuple[str, tuple[str, str | None, int]]]:
        """Calls that are due; with more than ``most`` held, also the next ones, at their time."""
        while waiting and (len(waiting) + n_behind > most or waiting[0][0] <= time.monotonic()):
            due, _, calls, folder, request = heapq.heappop(waiting)
            if (left := due - time.monotonic()) > 0:
                time.sleep(left)
            yield from called(folder, request, calls + 1)

    for folder, request in requests:
        if request["request_id"] in behind:
            behind[request["request_id"]].append((folder, request))
            n_behind += 1
        else:
            yield from called(folder, request, 1)
        yield from again(WAITING)
    yield from again(0)


def _pacer(seconds_between: float) -> Callable[[], None]:
    last = [0.0]

    def pace() -> None:
        delay = last[0] + seconds_between - time.monotonic()
        if delay > 0:
            time.sleep(delay)
        last[0] = time.monotonic()

    return pace


def by_workers(answer: Callable[[dict], str | None], log: str, *, clients: int = 8, attempts: int = 3, wait: float = 1.0,
               calls_per_second: float | None = None, log_every: int = 20) -> Fallback:
    """A fallback that calls ``answer(request) -> response JSON text`` in tasks.

    ``request``: a dict of ``request_id``, ``doc_id``, ``label``, ``prompt`` and ``request`` (JSON text). ``log``: a folder that
    driver and executors share, of a scheme that ``pyarrow.fs`` opens; the number of ``clients`` is part of its layout.
    """
    between = clients / calls_per_second if calls_per_second else 0.0

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, answers = {}, {}

        def open_requests() -> Iterator[tuple[str, dict]]:
            for batch in batches:
                for row in batch.to_pylist():
                    folder = f"{log}/client={row.pop('client')}"
                    if folder not in done:
                        done[folder] = _logged(folder)
                    if row["request_id"] not in done[folder]:
                        yield folder, row

        for folder, answered_request in _asked(answer, open_requests(), attempts, wait, _pacer(between)):
            mine = answers.setdefault(folder, [])
            mine.append(answered_request)
            if len(mine) >= log_every:
                _log(folder, answers.pop(folder))
        for folder, mine in answers.items():
            _log(folder, mine)
        yield pa.RecordBatch.from_arrays([pa.array([len(done)], pa.int64())], ["clients"])

    def fallback(requests: DataFrame) -> DataFrame:
        client = F.pmod(F.xxhash64("request_id"), F.lit(clients))
        asked = requests.select("request_id", "doc_id", "label", "prompt", F.to_json("request").alias("request"),
                                client.alias("client"))
        scratch = Scratch(requests.sparkSession)
        scratch.table(asked.repartition(clients, "client").mapInArrow(work, "clients bigint"), "work")
        scratch.remove()
        return answered(requests.sparkSession, log)

    return fallback


def answered(spark, log: str) -> DataFrame:
    """``LOG`` for every request in the log, one row each, an answer before a failure."""
    path = spark._jvm.org.apache.hadoop.fs.Path(log)
    if not path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path):
        return spark.createDataFrame([], LOG)
    rows = spark.read.schema(LOG + ", client int").parquet(log)
    return rows.groupBy("request_id").agg(F.min(F.struct(
        F.col("response_json").isNull(), "attempts", "response_json")).alias("a")).select(
        "request_id", "a.response_json", "a.attempts")
