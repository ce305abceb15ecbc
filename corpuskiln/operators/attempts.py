"""Retry loops as rows: attempts of a stage, and which one counts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskiln.functions import jsonx


def first_accepted(attempts: DataFrame, max_attempts: int, key: str = "ex_id") -> DataFrame:
    """attempts (key, attempt, ok, result, error), one row each: key, accepted, attempt, result; last_error if none is accepted.

    Narrow columns are aggregated; the winning result is joined back, so wide results cross the network once."""
    within = attempts.where(F.col("attempt") <= max_attempts)
    chosen = within.groupBy(key).agg(F.min(F.when(F.col("ok"), F.col("attempt"))).alias("won"), F.max("attempt").alias("tries"))
    picked = within.select(key, "attempt", "result", "error").join(chosen.withColumn("attempt", F.coalesce("won", "tries")), [key, "attempt"])
    won = F.col("won").isNotNull()
    return picked.select(key, won.alias("accepted"), "attempt", F.when(won, F.col("result")).alias("result"), F.when(~won, F.col("error")).alias("last_error"))


def value_digests(texts: DataFrame, text: str, key: str = "ex_id") -> DataFrame:
    """(key, d): what ``jsonx.digests_of`` tells of each text. Made once for the originals, it serves any number of rounds."""
    return texts.select(key, jsonx.digests_of(F.col(text))[0].alias("d"))


def candidate_errors(candidates: DataFrame, originals: DataFrame, key: str = "ex_id") -> DataFrame:
    """value_digests of responses and of originals, joined: (key, error) as ``jsonx.check_candidate_strict`` gives, by comparing
    names and digests alone. A response without an original has the error that it lacks one."""
    d, o = F.col("d"), F.col("o")
    both = candidates.join(originals.select(key, F.col("d").alias("o")), key, "left")
    # an original is taken as it stands: a list of one object isn't one
    usable = F.coalesce(o["error"].isNull() & o["is_object"] & ~o["listed"], F.lit(False))
    places = F.filter(F.sequence(F.lit(0), F.size(o["names"]) - 1), lambda k: (F.get(o["names"], k) != "problem") & ~F.coalesce(F.get(o["digests"], k) == F.get(d["digests"], k), F.lit(False)))
    changed = F.when(F.size(o["names"]) > 0, F.get(o["names"], F.get(places, F.lit(0))))
    before, after = jsonx.CHANGED.split("{}")
    fault = (
        F.when(~usable, jsonx.NO_ORIGINAL).when(d["error"].isNotNull(), d["error"]).when(d["many"], jsonx.MANY).when(~d["is_object"], jsonx.NOT_OBJECT)
        .when(d["names"] != o["names"], jsonx.OTHER_KEYS).when(changed.isNotNull(), F.concat(F.lit(before), changed, F.lit(after))).when(~d["text_problem"], jsonx.NOT_STRING).otherwise("")
    )
    return both.select(key, fault.alias("error"))


def repair_outcome(rounds: DataFrame, max_rounds: int, key: str = "ex_id") -> DataFrame:
    """rounds (key, attempt, usable, valid): key, fixed, fixed_at, repair_attempts, status.

    A round without usable code costs a round; repair_attempts is the last usable one up to the first success."""
    within = rounds.where(F.col("attempt") <= max_rounds)
    first = within.groupBy(key).agg(F.min(F.when(F.col("usable") & F.col("valid"), F.col("attempt"))).alias("fixed_at"), F.max(F.when(F.col("usable"), F.col("attempt"))).alias("last_usable"))
    return first.select(
        key, F.col("fixed_at").isNotNull().alias("fixed"), "fixed_at", F.coalesce("fixed_at", "last_usable", F.lit(0)).cast("int").alias("repair_attempts"),
        F.when(F.col("fixed_at").isNotNull(), "valid").otherwise("repair_failed").alias("status"),
    )


def failed_labels(outcomes: DataFrame, failed: str, group: list[str]) -> DataFrame:
    """Labels (seq, label) of failed rows in input order, one list for each group, such as a file: no row has the corpus's."""
    if not group:
        raise ValueError("lists need a group, such as the file")
    return outcomes.where(failed).groupBy(*group).agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "label"))), lambda x: x["label"]).alias("labels"))


def respond(prompts: DataFrame, factory: Callable[[], Callable[[str], dict]], stage: str, key: str = "ex_id") -> DataFrame:
    """prompts (key, attempt, prompt) through a model that the caller supplies: factory() is called once a partition and gives
    a function of a prompt to a dict of response and, if known, the three token counts and usage_source. A call that raises
    gives a row with its error. Calls may repeat when a task is retried: write the result before using it."""
    import pandas as pd

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = factory()

        def one(prompt):
            try:
                return {"error": None} | ask(prompt)
            except Exception as e:  # noqa: BLE001  the caller's model may raise anything
                return {"error": f"{type(e).__name__}: {e}"}

        for f in (f.iloc[at : at + jsonx.ROWS].copy() for f in frames for at in range(0, len(f), jsonx.ROWS)):
            got = pd.DataFrame([one(p) for p in f["prompt"]], index=f.index)
            for c, empty in (("response", None), ("prompt_tokens", 0), ("completion_tokens", 0), ("total_tokens", 0), ("usage_source", "none"), ("error", None)):
                f[c] = got[c].where(got[c].notna(), empty) if c in got else empty
            yield f[[key, "attempt", "response", "prompt_tokens", "completion_tokens", "total_tokens", "usage_source", "error"]]

    kind = prompts.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, attempt int, response string, prompt_tokens long, completion_tokens long, total_tokens long, usage_source string, error string"
    return prompts.select(key, F.col("attempt").cast("int"), "prompt").mapInPandas(run, schema).withColumn("stage", F.lit(stage))


def compile_with(files: DataFrame, factory: Callable[[], Callable[[str, str], tuple[str, str, int]]], partitions: int | None = None, key: str = "ex_id") -> DataFrame:
    """files (key, file_name, content) through a compiler that the caller supplies: (stdout, stderr, returncode) of a file.

    TimeoutError becomes a log with one error at 0:0 and returncode 1."""
    import pandas as pd

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        build = factory()

        def one(name, content):
            try:
                out, err, code = build(name, content)
                return f"{out}\n{err}", code
            except TimeoutError as e:
                return f"{name}:0:0: error: {e or 'stopped'}", 1

        for f in frames:
            got = [one(n, c) for n, c in zip(f["file_name"], f["content"])]
            yield pd.DataFrame({key: f[key], "file_name": f["file_name"], "output": [g[0] for g in got], "returncode": [g[1] for g in got]})

    dealt = files.repartition(partitions, key) if partitions else files
    return dealt.select(key, "file_name", "content").mapInPandas(run, f"{key} {files.schema[key].dataType.simpleString()}, file_name string, output string, returncode int")


def run_rounds(work: DataFrame, step: Callable[[DataFrame, int], DataFrame], max_rounds: int, write: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
    """Rounds of step over what has failed so far. step gives work's rows with ``ok`` and others; write stores a round in the
    shared folder and reads it back, so no paid call is repeated. The last round's failures stay failures."""
    done = None
    for k in range(1, max_rounds + 1):
        result = write(step(work, k).withColumn("round", F.lit(k)), k)
        final = result if k == max_rounds else result.where("ok")
        done = final if done is None else done.unionByName(final)
        work = result.where("NOT ok").select(*work.columns)
        if k < max_rounds and work.isEmpty():
            break
    return done
