"""Replacing a folder without ever losing its rows: write aside, then two renames.

``replace_folder`` writes to ``_new.<name>.<id>`` beside the folder; readers skip names that begin with an underscore. When the write is
committed (``_SUCCESS`` lies there) the old folder is renamed to ``_old.<name>.<id>`` and the new one to its place. A job that dies

* before the first rename leaves the old rows in place, and an unused new folder;
* between the renames leaves both folders aside. ``recover`` puts the new one in place: it is whole, and the swap had begun;
* after the second rename leaves the new rows in place, and an unused old folder.

``recover`` runs before every replacement, which also removes what lies unused, and before every read through ``read_days``, which
removes nothing, as a writer may be at work. Two rules hold for users: one writer at a time per folder, and a file
system with atomic renames of folders (HDFS, local disks); an object store copies instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from lakeshelf.sources.files import exists, list_aside, rename, remove

NEW, OLD = "_new.", "_old."


def _split(path: str) -> tuple[str, str]:
    parent, _, name = path.rstrip("/").rpartition("/")
    # A hidden name must not look like a partition's.
    return parent, name.replace("=", "-")


def staged_path(path: str) -> str:
    """A fresh folder beside ``path`` that readers skip."""
    parent, name = _split(path)
    return f"{parent}/{NEW}{name}.{uuid.uuid4().hex}"


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """``write`` fills the folder it is given, which then takes the place of ``path``."""
    recover(spark, path, tidy=True)
    staged = staged_path(path)
    write(staged)
    swap(spark, staged, path)


def swap(spark: SparkSession, staged: str, path: str) -> None:
    """Put a finished folder ``staged`` in the place of ``path``."""
    if not exists(spark, f"{staged}/_SUCCESS"):
        raise OSError(f"{staged} is not a finished write")
    parent, name = _split(path)
    old = f"{parent}/{OLD}{name}.{staged.rpartition('.')[2]}"
    replaced = exists(spark, path)
    if replaced:
        rename(spark, path, old)
    try:
        rename(spark, staged, path)
    except OSError:
        # A reader that found the folder missing may have put the new one in place.
        if exists(spark, staged) or not exists(spark, path):
            raise
    if replaced:
        remove(spark, old)


def recover(spark: SparkSession, path: str, aside: list[str] | None = None, tidy: bool = False) -> None:
    """Put ``path`` in place if a job died while it replaced it, and with ``tidy`` remove what such jobs left.

    ``aside`` are the hidden names beside the folder, if known.
    """
    parent, name = _split(path)
    aside = list_aside(spark, parent) if aside is None else aside
    new, old = ([n for n in aside if n.startswith(f"{kind}{name}.")] for kind in (NEW, OLD))
    if not new and not old:
        return
    if old and not exists(spark, path):
        started = {n.rpartition(".")[2]: n for n in new}
        whole = [started[n.rpartition(".")[2]] for n in old if n.rpartition(".")[2] in started]
        whole = [n for n in whole if exists(spark, f"{parent}/{n}/_SUCCESS")]
        rename(spark, f"{parent}/{(whole or old)[0]}", path)
    for rest in (new + old) * tidy:
        remove(spark, f"{parent}/{rest}")


def recover_all(spark: SparkSession, root: str) -> None:
    """Put every folder of ``root`` in place that a dead job left aside; one listing if nothing lies aside."""
    aside = list_aside(spark, root) if exists(spark, root) else []
    for name in {n.removeprefix(NEW).removeprefix(OLD).rpartition(".")[0] for n in aside if n.startswith((NEW, OLD))}:
        column, dash, value = name.partition("-")
        recover(spark, f"{root}/{column}={value}" if dash and column == "report_date" else f"{root}/{name}", aside)
