"""Asking a service about many rows at once: bounded concurrency, retries, and a deadline that holds whatever the client does."""

from __future__ import annotations

import queue
import threading
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

OK, TIMEOUT, FAILED = "OK", "TIMEOUT", "FAILED"


@dataclass
class Answer:
    row: object
    status: str
    value: object  # of the last call that returned; None if none did
    error: Exception | None  # of the last call that raised
    attempts: int


AHEAD = 1000  # rows that are taken from the source before their answers are given out
LOOK = 0.05  # seconds between two looks at the deadlines while answers come in


class _Row:
    __slots__ = ("row", "deadline", "attempts", "value", "error", "open")

    def __init__(self, row: object):
        self.row, self.deadline, self.attempts, self.value, self.error = row, None, 0, None, None
        self.open = [True]

    def settle(self) -> bool:
        """True for the first who asks: the thread with its answer, or the one that looks after deadlines."""
        try:
            return self.open.pop()
        except IndexError:
            return False

    def answer(self, status: str) -> Answer:
        return Answer(self.row, status, self.value, self.error, self.attempts)


def ask_all(
    rows: Iterable[object],
    client: Callable,
    capacity: int,
    timeout: float | None = None,
    attempts: int = 1,
    pause: float = 0.0,
    accept: Callable[[object], bool] = lambda value: True,
) -> Iterator[Answer]:
    """An answer per row, in the order in which they end.

    ``client(row, remaining seconds)`` runs on up to ``capacity`` threads, each with one row at a time from its first attempt to
    its end. A value that is not accepted and any exception, a client's own time-out too, is tried again until the attempts are
    used up (FAILED). The timeout covers all attempts and the pauses between them; when it runs out the row ends (TIMEOUT), and
    a value that comes later is ignored. A client that never returns keeps its thread; another one takes the thread's place.

    Rows lie ready for the threads and answers are collected as many as there are, so a row costs no change of threads.
    """
    todo, done = queue.SimpleQueue(), queue.SimpleQueue()
    busy: dict[int, _Row] = {}

    def ask(row: _Row) -> str:
        while True:
            row.attempts += 1
            left = row.deadline - time.monotonic() if timeout is not None else float("inf")
            try:
                row.value, row.error = client(row.row, left), None
            except Exception as e:
                row.error = e
            now = time.monotonic()
            if timeout is not None and now > row.deadline:
                return TIMEOUT
            if row.error is None and accept(row.value):
                return OK
            if row.attempts >= attempts:
                return FAILED
            if timeout is not None and now + pause >= row.deadline:
                return TIMEOUT
            if pause:
                time.sleep(pause)

    def work() -> None:
        own = threading.get_ident()
        while (row := todo.get()) is not None:
            if timeout is not None:
                row.deadline = time.monotonic() + timeout
                busy[own] = row
            status = ask(row)
            busy.pop(own, None)
            if not row.settle():  # it was given up and this thread replaced
                return
            done.put(row.answer(status))

    def hire() -> None:
        threading.Thread(target=work, daemon=True).start()

    def overdue(now: float) -> list[Answer]:
        late = []
        for own, row in list(busy.items()):
            if row.deadline <= now and row.settle():
                busy.pop(own, None)
                hire()
                late.append(row.answer(TIMEOUT))
        return late

    source, fed, given, threads, exhausted, looked = iter(rows), 0, 0, 0, False, time.monotonic()
    try:
        while True:
            while not exhausted and fed - given < max(AHEAD, capacity):
                item = next(source, _END)
                if item is _END:
                    exhausted = True
                    break
                todo.put(_Row(item))
                fed += 1
                if threads < min(capacity, fed - given):
                    threads += 1
                    hire()
            if fed == given:
                return
            answers = []
            while len(answers) < AHEAD:
                try:
                    answers.append(done.get_nowait())
                except queue.Empty:
                    break
            now = time.monotonic()
            if timeout is not None and (not answers or now - looked > LOOK):
                answers += overdue(now)
                looked = now
            if not answers:
                soonest = min((row.deadline for row in list(busy.values())), default=now + LOOK)
                try:
                    answers.append(done.get(timeout=max(0.001, min(soonest - now, 10 * LOOK)) if timeout is not None else None))
                except queue.Empty:
                    continue
            given += len(answers)
            yield from answers
    finally:
        for _ in range(threads + len(busy)):
            todo.put(None)


_END = object()
