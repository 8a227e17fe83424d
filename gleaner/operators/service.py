"""Driver-side services of a run: pacing, budgets, the lock, prompts, grids, Markdown."""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from pathlib import Path

from pyspark.sql import DataFrame


class TokenBucket:
    """So many units a minute; ``take`` waits until they are there."""

    def __init__(self, per_minute: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rate, self.size, self.level, self.clock, self.sleep, self.at = per_minute / 60, per_minute, per_minute, clock, sleep, clock()

    def take(self, units: float) -> None:
        units = min(units, self.size)
        now = self.clock()
        self.level, self.at = min(self.size, self.level + (now - self.at) * self.rate), now
        if units > self.level:
            wait = (units - self.level) / self.rate
            self.sleep(wait)
            self.level, self.at = self.level + wait * self.rate, self.at + wait
        self.level -= units


class Pacer:
    """At least so many seconds between two requests to a host."""

    def __init__(self, seconds: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.seconds, self.clock, self.sleep, self.last = seconds, clock, sleep, {}

    def wait(self, host: str) -> None:
        now = self.clock()
        due = self.last.get(host, now - self.seconds) + self.seconds
        if due > now:
            self.sleep(due - now)
        self.last[host] = max(now, due)


def retried(call: Callable[[], object], wait: Callable[[int, Exception], float | None], tries: int = 4, sleep: Callable[[float], None] = time.sleep) -> object:
    """The result of a call; ``wait`` says how long to wait after a failure, None gives up."""
    for n in range(tries):
        try:
            return call()
        except Exception as error:  # noqa: BLE001  the caller decides what is worth another try
            pause = wait(n, error)
            if pause is None or n + 1 == tries:
                raise
            sleep(pause)
    raise ValueError("no tries")


@contextmanager
def run_lock(path: str, owner: str) -> Iterator[None]:
    """One run at a time; its owner may enter again."""
    lock = Path(path)
    try:
        with os.fdopen(os.open(lock, os.O_CREAT | os.O_EXCL | os.O_WRONLY), "w") as f:
            f.write(owner)
        mine = True
    except FileExistsError:
        held = lock.read_text()
        if held != owner:
            raise RuntimeError(f"a run of {held} holds the lock") from None
        mine = False
    try:
        yield
    finally:
        if mine:
            with suppress(FileNotFoundError):
                lock.unlink()


def load_prompt(name: str, version: str, folder: str) -> str:
    """The text of one version of a prompt."""
    path = Path(folder) / f"{name}_{version}.md"
    if not path.is_file():
        raise FileNotFoundError(f"prompt {name} has no version {version}")
    return path.read_text(encoding="utf-8")


def grid(rows: DataFrame, most: int) -> list[list[str]]:
    """Header and rows of a sheet, at most so many rows; more are refused."""
    found = rows.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"a sheet takes {most} rows at most")
    return [list(rows.columns), *(["" if v is None else str(v) for v in r] for r in found)]


def workbook(sheets: dict[str, list[list[str]]], most_cells: int, chunk: int = 500) -> tuple[dict[str, list[list[list[str]]]], list[str]]:
    """Sheets in chunks of rows as they are pushed, and those left out because the
    workbook would have more than so many cells."""
    out, left, cells = {}, [], 0
    for name, rows in sheets.items():
        size = sum(map(len, rows))
        if cells + size > most_cells:
            left.append(name)
            continue
        cells += size
        out[name] = [rows[i : i + chunk] for i in range(0, len(rows), chunk)]
    return out, left


def markdown(title: str, rows: DataFrame, most: int = 200) -> str:
    """A report of one table."""
    head, *body = grid(rows, most)
    line = lambda cells: "| " + " | ".join(c.replace("|", "\\|").replace("\n", " ") for c in cells) + " |"
    return "\n".join([f"# {title}", "", line(head), line(["---"] * len(head)), *map(line, body or [["no rows", *[""] * (len(head) - 1)]]), ""])
