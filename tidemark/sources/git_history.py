"""A batch data source of one file's versions in git repositories, oldest first.

spark.dataSource.register(GitHistory); then
spark.read.format("git_history").option("specs", "dir::file;dir::file").load()
has a row per commit: spec, ord, commit, time, content.  Commits are listed on
the driver, contents are read by the tasks, some commits each.
"""

from __future__ import annotations

import subprocess
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Versions that a task reads.
PER_TASK = 50


def parse_spec(spec: str) -> tuple[str, str]:
    folder, mark, file = spec.partition("::")
    if not mark or not folder or not file:
        raise ValueError(f"a history is given as folder::file, not {spec!r}")
    return folder, file


def git(folder: str, *args: str) -> str:
    done = subprocess.run(["git", "-C", folder, *args], capture_output=True, text=True)
    if done.returncode:
        raise RuntimeError(f"git {args[0]} failed in {folder}: {done.stderr.strip()[:300]}")
    return done.stdout


class _Some(InputPartition):
    def __init__(self, rows: list[tuple]) -> None:
        self.rows = rows


class _Reader(DataSourceReader):
    def __init__(self, specs: list[tuple[str, str]]) -> None:
        self.specs = specs

    def partitions(self) -> list[InputPartition]:
        rows = []
        for i, (folder, file) in enumerate(self.specs):
            lines = git(folder, "log", "--reverse", "--format=%H %ct", "--", file).split("\n")
            rows += [(i, n, *line.split()) for n, line in enumerate(x for x in lines if x)]
        rows.sort(key=lambda r: (int(r[3]), r[0], r[1]))
        return [_Some([(*r, n + a) for n, r in enumerate(rows[a : a + PER_TASK])]) for a in range(0, len(rows), PER_TASK)] or [_Some([])]

    def read(self, partition: _Some) -> Iterator[tuple]:
        for i, _, commit, time, order in partition.rows:
            folder, file = self.specs[i]
            yield f"{folder}::{file}", order, commit, int(time), git(folder, "show", f"{commit}:{file}")


class GitHistory(DataSource):
    @classmethod
    def name(cls) -> str:
        return "git_history"

    def schema(self) -> str:
        return "spec string, ord int, commit string, time long, content string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader([parse_spec(s) for s in self.options["specs"].split(";") if s])
