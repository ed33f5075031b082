"""A user's function or program for each group, with failures as rows."""

from __future__ import annotations

import os
import signal
import subprocess
import traceback
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, as_completed, wait
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ERROR, FIRST, LACKS = "group_error", "group_first", "group_lacks_"
PACKED = 1000  # rows and groups in a frame of results
AT_ONCE = 8


def map_groups(df: DataFrame, keys: Sequence[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType, at_once: int = 1) -> tuple[DataFrame, DataFrame]:
    """Rows that fn returns for each group, and (keys, group_error) of the groups where it failed. schema is that of fn's
    rows; a group is one task's pandas frame, so keys must be as fine as a genome or a marker. Up to at_once groups of a task
    are in fn side by side, in threads, which is of use where it waits.

    Spark brings the rows of a group together and marks its first; the groups' frames are cut out of whole batches of rows, so
    that many small groups cost one conversion. Both tables come from one with an error column, written once to the checkpoint
    folder, so fn runs once a group."""
    keys = list(keys)
    own = [f for f in schema.fields if f.name not in keys]
    out = T.StructType([*(T.StructField(f.name, f.dataType) for f in df.schema.fields if f.name in keys), *(T.StructField(f.name, f.dataType) for f in own), T.StructField(ERROR, T.StringType())])
    whole = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.IntegralType, T.BooleanType))]

    def run(rows: pd.DataFrame) -> tuple[tuple, pd.DataFrame, str | None]:
        key = tuple(rows[k].iloc[0] for k in keys)
        kinds = tuple(rows[k].dtype for k in keys)
        try:
            return (key, kinds), fn(rows), None
        except Exception:  # the failure becomes a row
            return (key, kinds), pd.DataFrame([{f.name: None for f in own}], dtype=object), traceback.format_exc(limit=-1)

    def pack(got: Iterator[tuple[tuple, pd.DataFrame, str | None]]) -> Iterator[pd.DataFrame]:
        """The rows of many groups in one frame; only rows of the same types meet, so that no value changes its type."""
        held: dict[tuple, list] = defaultdict(list)
        waiting: dict[tuple, int] = defaultdict(int)

        def close(kind: tuple) -> pd.DataFrame:
            parts, _ = held.pop(kind), waiting.pop(kind)
            of = np.repeat(np.arange(len(parts)), [len(rows) for _, rows, _ in parts])
            named = {k: pd.Series([key[n] for key, _, _ in parts], dtype=kind[0][n]).iloc[of].array for n, k in enumerate(keys)}
            errors = pd.Series([e for _, _, e in parts], dtype=object).iloc[of].array
            return pd.concat([rows for _, rows, _ in parts], ignore_index=True).assign(**named, **{ERROR: errors}).reindex(columns=[f.name for f in out.fields])

        for (key, kinds), rows, error in got:
            kind = (kinds, error is None, tuple(rows.columns), tuple(rows.dtypes))
            held[kind].append((key, rows, error))
            waiting[kind] += len(rows) + 1
            if waiting[kind] > PACKED:
                yield close(kind)
        for kind in list(held):
            yield close(kind)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = cut(batches, whole)
        yield from pack(map(run, found) if at_once == 1 else side_by_side(run, found, at_once))

    first = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0))) == 1
    lacks = {f"{LACKS}{c}": F.col(c).isNull() for c in whole}
    filled = {c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in whole}
    every = df.withColumns({FIRST: first, **lacks}).withColumns(filled).mapInPandas(each, out).checkpoint()
    return every.where(f"{ERROR} is null").select(*[f.name for f in schema.fields]), every.where(f"{ERROR} is not null").select(*keys, ERROR)


def cut(batches: Iterator[pd.DataFrame], whole: Sequence[str]) -> Iterator[pd.DataFrame]:
    """A frame for each group, of batches in which a group's first row is marked, and so are the nulls of whole numbers and
    truth values: only a group that has some gets them, so the others' numbers stay what they are."""

    def frame(parts: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0].reset_index(drop=True)
        for c in [c for c in whole if f"{LACKS}{c}" in rows.columns]:
            if (absent := rows.pop(f"{LACKS}{c}").fillna(False).astype(bool)).any():
                rows[c] = rows[c].astype(object if rows[c].dtype == bool else float).mask(absent, None)
        return rows

    held: list[pd.DataFrame] = []
    for batch in batches:
        starts = np.flatnonzero(batch.pop(FIRST).to_numpy())
        batch = batch.drop(columns=[f"{LACKS}{c}" for c in whole if not batch[f"{LACKS}{c}"].any()])
        before = batch.iloc[: starts[0] if len(starts) else len(batch)]
        if len(before):
            held.append(before)
        for a, b in pairwise([*starts, len(batch)]):
            if held:
                yield frame(held)
            held = [batch.iloc[a:b]]
    if held:
        yield frame(held)


def side_by_side(fn: Callable, given: Iterator, most: int) -> Iterator:
    """What fn makes of the given, up to so many at a time, each as soon as it is done."""
    with ThreadPoolExecutor(most) as pool:
        running = set()
        for x in given:
            running.add(pool.submit(fn, x))
            if len(running) == most:
                done, running = wait(running, return_when=FIRST_COMPLETED)
                yield from (f.result() for f in done)
        yield from (f.result() for f in as_completed(running))


class ProgramError(RuntimeError):
    """What a program left behind: its end and the last of what it said."""


def run_program(command: Sequence[str], given: str, seconds: float, environment: dict[str, str] | None = None, said: int = 2000) -> str:
    """What a program writes when it is given a text. It runs in a process group of its own, which is killed as a whole when
    its time is up, children included; another end than 0, or none in time, is an error with the end of its error output."""
    process = subprocess.Popen(command, stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.PIPE, text=True, encoding="utf-8", errors="replace", start_new_session=True, env=os.environ | (environment or {}))
    try:
        out, err = process.communicate(given, timeout=seconds)
        ended = f"ended with {process.returncode}"
    except subprocess.TimeoutExpired:
        ended = f"killed after {seconds:g} s"
    finally:
        try:
            os.killpg(process.pid, signal.SIGKILL)  # whatever it has left running
        except ProcessLookupError:
            pass
    if ended.startswith("killed"):
        _, err = process.communicate()
    if ended != "ended with 0":
        raise ProgramError(f"{command[0]} {ended}: {err[-said:].strip()}")
    return out


def map_programs(df: DataFrame, keys: Sequence[str], command: Sequence[str], text: Callable[[pd.DataFrame], str], read: Callable[[str], pd.DataFrame], schema: T.StructType, seconds: float = 3600.0, at_once: int = AT_ONCE) -> tuple[DataFrame, DataFrame]:
    """An external program (an aligner, say) once for each group: text makes its input of the group's rows, read makes rows of its
    output. Up to at_once programs of a task run side by side, so that one that waits does not keep the others; a program that
    needs a core and memory for itself takes at_once = 1. Rows, and (keys, group_error) of the groups where it failed, was too slow, or could not be started; the keys are in its
    environment as GROUP_<KEY>. The program must be on every executor. schema is that of read's rows."""
    keys = list(keys)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        named = {f"GROUP_{k.upper()}": str(rows[k].iloc[0]) for k in keys}
        return read(run_program(command, text(rows), seconds, named))

    return map_groups(df, keys, run, schema, at_once)
