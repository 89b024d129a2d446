"""Rows through an external command."""

from __future__ import annotations

import os
import subprocess
import threading
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BATCH = 4096


def pipe(
    df: DataFrame,
    column: str,
    argv: list[str],
    env: dict[str, str] | None = None,
    print_context: Callable[[Callable[[str], None]], None] | None = None,
    print_row: Callable[[str, Callable[[str], None]], None] | None = None,
) -> DataFrame:
    """(line): what one process per partition answers to the partition's rows, written to it as lines.

    A null row is an empty line.  ``env`` adds to the worker's environment.  ``print_context`` writes lines
    before the first row, ``print_row`` the lines of a row (the row itself by
    default).  A thread feeds the process while its answer is read, so neither
    side is held in memory.  A partition without rows starts a process too.  A
    status other than zero fails the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        process = subprocess.Popen(argv, stdin=subprocess.PIPE, stdout=subprocess.PIPE, text=True, env=os.environ | (env or {}))
        failed: list[BaseException] = []

        def out(line: str) -> None:
            process.stdin.write(f"{line}\n")

        def feed() -> None:
            try:
                if print_context:
                    print_context(out)
                for batch in batches:
                    for row in batch.column(0).fill_null("").to_pylist():
                        if print_row:
                            print_row(row, out)
                        else:
                            out(row)
                process.stdin.close()
            except BrokenPipeError:
                pass  # the command has read enough
            except BaseException as error:  # noqa: BLE001  raised again in the task
                failed.append(error)
                process.kill()

        feeder = threading.Thread(target=feed, daemon=True)
        feeder.start()
        lines: list[str] = []
        for line in process.stdout:
            lines.append(line.rstrip("\n"))
            if len(lines) >= _BATCH:
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["line"])
                lines = []
        feeder.join()
        status = process.wait()
        if failed:
            raise failed[0]
        if status:
            raise RuntimeError(f"{argv[0]} ended with status {status}")
        if lines:
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["line"])

    return df.select(F.col(column).cast("string")).mapInArrow(run, "line string")
