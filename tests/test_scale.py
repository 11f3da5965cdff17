"""Plans that decide how the queries grow: what is shuffled, by how many tasks, and how the rules are compiled."""

import contextlib
import io
import os
import re

from pyspark.sql import functions as F

from docsift import catalog
from docsift.functions.regex import strip
from docsift.operators.engine import apply_rules
from docsift.operators.extract import extract, prepare_jobs
from docsift.session import materialize
from docsift.sources.sinks import read_results_in_order, write_results_in_order
from docsift.streaming.incremental import new_store, read_report
from sf_paths import SF_SMALL as SMOKE


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def jobs(spark):
    return prepare_jobs(catalog.fixture_docs(spark, SMOKE, "both"), request="request", dealt=True)


def test_rules_are_compiled(spark):
    """No generated method is beyond the 8,000 bytes that the JVM compiles."""
    stored = materialize(jobs(spark), "jobs")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            apply_rules(stored).select("job_id", "found_all").explain("codegen")
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
    assert sizes and max(sizes) < 8000


def test_keys_are_dealt_and_not_texts(spark):
    """Cards, screens and long runs are spread by the columns that they are made of, once."""
    dealt = re.findall(r"Exchange RoundRobin", plan(jobs(spark)))
    assert len(dealt) == 2                                              # one a table
    lines = plan(catalog.rules_long_runs(spark, SMOKE)).splitlines()
    below = lines[next(i for i, line in enumerate(lines) if "Exchange" in line) + 1:]
    assert not any("JOAO" in line for line in below)


def test_a_streamed_part_is_many_files(spark):
    """Each of the four micro-batches is written and read by all cores."""
    store = catalog._streamed(spark, SMOKE)
    folder = os.path.join(os.path.dirname(store).removeprefix("file:"), "incoming")
    files = [f for f in os.listdir(folder) if f.endswith(".parquet")]
    assert len(files) > 4 * spark.sparkContext.defaultParallelism // 2
    assert 3 <= read_report(spark, store).select("batch_id").distinct().count() <= 4


def test_ordered_lines_are_not_moved(spark):
    """Places come from the splits' line counts; no line goes through an exchange."""
    path = new_store(spark, "test-ordered")
    run = extract(jobs(spark), fallback=catalog.fixture_fallback)
    write_results_in_order(run.results, path, files=3)
    lines = read_results_in_order(spark, path)
    assert not [x for x in plan(lines).splitlines() if "Exchange" in x and "piece" in x] and "Window [sum(cast" not in plan(lines)
    got = [r["job_id"] for r in lines.select("position", F.get_json_object("line", "$.job_id").cast("long").alias("job_id"))
           .orderBy("position").collect()]
    assert got == sorted(got) and len(got) == run.results.count()


def test_results_are_formed_once_for_the_cache_too(spark):
    run = extract(jobs(spark), fallback=catalog.fixture_fallback, cache_too=True)
    assert "from_json" not in plan(run.results) and "from_json" not in plan(run.new_cache)
    plain = extract(jobs(spark), fallback=catalog.fixture_fallback)
    for a, b in ((run.results, plain.results), (run.new_cache.drop("created_at"), plain.new_cache.drop("created_at"))):
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_strip_removes_what_python_strips(spark):
    values = [f"{c}a{c} b{c}{c}" for c in map(chr, range(0x3002)) if not 0xD800 <= ord(c) < 0xE000] + ["", " \n\u3000", "\n x", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r["i"]: r["s"] for r in df.select("i", strip(F.col("v")).alias("s")).collect()}
    assert got == {i: v if v is None else v.strip() for i, v in enumerate(values)}
