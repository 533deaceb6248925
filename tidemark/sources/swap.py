"""Replacing folders of stored tables by renames that survive an interruption.

A swap is a list of moves: old content *out* to a folder aside, new content *in* from where
it was written.  Before the first rename the list is written to a journal beside the table;
after the last one the journal is removed, then what was moved aside.  Whoever reads or
writes the table next and finds a journal finishes the swap, so at every moment each folder's
old or new content exists, and what a finished read sees is all new.

A rename that fails (and only that) undoes the swap at once; if the undoing fails as well, or
the process is interrupted or killed, the journal stays and the next user of the table
finishes the swap.  One writer at a time: a journal that this process is working through is
left alone by its other threads.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tidemark.session import delete_path, path_exists, read_text, rename_path, write_text

OUT, IN = "out", "in"
_active: set[str] = set()


def journal_path(path: str) -> str:
    """The journal of the table at ``path``, in the folder that holds the table."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_swap-{name}.json"


def _move(spark: SparkSession, kind: str, src: str, dst: str, rename) -> None:
    """Make one move unless it was made: what was moved out lies aside, what was moved in is
    gone from where it was written."""
    if not path_exists(spark, dst) if kind == OUT else path_exists(spark, src):
        rename(spark, src, dst)


def _finish(spark: SparkSession, journal: str, moves, drop, rename) -> None:
    for move in moves:
        _move(spark, *move, rename)
    _close(spark, journal, drop)


def _close(spark: SparkSession, journal: str, drop) -> None:
    """The journal goes first: without the folders that it names it could not be followed."""
    delete_path(spark, journal)
    for path in drop:
        delete_path(spark, path)


def _undo(spark: SparkSession, journal: str, moves, drop, rename) -> None:
    for kind, src, dst in reversed(moves):
        done = path_exists(spark, dst) if kind == OUT else not path_exists(spark, src)
        if done:
            rename(spark, dst, src)
    _close(spark, journal, drop)


def swap(spark: SparkSession, path: str, moves: Sequence[tuple[str, str, str]],
         drop: Sequence[str], rename=rename_path) -> None:
    """Carry out ``moves`` (kind, from, to) for the table at ``path``, then delete ``drop``."""
    recover(spark, path)
    journal = journal_path(path)
    _active.add(journal)
    try:
        draft = f"{journal}.draft"
        write_text(spark, draft, json.dumps({"moves": list(moves), "drop": list(drop)}))
        rename_path(spark, draft, journal)
        try:
            for move in moves:
                _move(spark, *move, rename)
        except Exception:
            _undo(spark, journal, moves, drop, rename)
            raise
        _finish(spark, journal, [], drop, rename)
    finally:
        _active.discard(journal)


def recover(spark: SparkSession, path: str, rename=rename_path) -> bool:
    """Finish an interrupted swap of the table at ``path``; whether there was one."""
    journal = journal_path(path)
    if journal in _active or not path_exists(spark, journal):
        return False
    todo = json.loads(read_text(spark, journal))
    _finish(spark, journal, [tuple(m) for m in todo["moves"]], todo["drop"], rename)
    return True
