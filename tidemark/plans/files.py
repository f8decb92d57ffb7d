"""Reports that a user keeps as files: a configuration, Spark SQL and Python modules.

A folder has ``reports.toml`` with a table ``[reports.<name>]`` for each report
(``title``, ``frequency``, ``source``, ``starts``, ``labels``) and, by its name, ``<name>.sql``
or ``<name>.py``; the SQL is taken if both are there. As in the catalogue a time-boxed report (one
with ``starts``) that is refreshed hourly has a bucket a day, any other one a month. SQL names the logical tables
and the parameters ``:as_of``, ``:starts``, ``:ends`` and ``:n``, which are bound, never pasted.
A module has ``build(tables, params)``. Only the driver reads the folder: what a module
sends to the tasks goes there by value.
"""

from __future__ import annotations

import importlib.util
import re
import sys
import tomllib
from collections.abc import Callable, Mapping
from pathlib import Path
from types import ModuleType

from pyspark import cloudpickle
from pyspark.sql import DataFrame

from ..operators.timebox import FREQUENCY_SECONDS
from .reports import REPORTS, Params, Report, run_sql_report

CONFIG = "reports.toml"
FIELDS = {"title", "frequency", "source", "starts", "labels"}


def _module(path: Path) -> ModuleType:
    """The module at ``path``, under a name of its own; its functions are pickled by value."""
    name = "tidemark_report_" + re.sub(r"\W", "_", str(path.resolve()))
    spec = importlib.util.spec_from_file_location(name, path)
    module = importlib.util.module_from_spec(spec)
    sys.modules[name] = module
    spec.loader.exec_module(module)
    cloudpickle.register_pickle_by_value(module)
    return module


def _from_sql(text: str) -> Callable[[Mapping[str, DataFrame], Params], DataFrame]:
    code = re.sub(r"--[^\n]*|/\*.*?\*/|'(?:[^'\\]|\\.|'')*'", " ", text, flags=re.S)
    wanted = set(re.findall(r"(?<![:\w]):([A-Za-z_]\w*)", code))
    unknown = wanted - {"as_of", "starts", "ends", "n"}
    if unknown:
        raise ValueError(f"unknown parameters: {', '.join(sorted(unknown))}")

    def build(tables: Mapping[str, DataFrame], p: Params) -> DataFrame:
        # a report without a time box has no starts; its ends is the day it is made for
        values = {"as_of": p.as_of, "starts": p.starts, "ends": p.ends or p.as_of, "n": p.n}
        named = [t for t in tables if re.search(rf"\b{re.escape(t)}\b", code)]
        if not named:
            raise ValueError("the SQL names none of the tables")
        session = tables[named[0]].sparkSession
        return run_sql_report(session, tables, text, {k: values[k] for k in wanted}, named)

    return build


def load_reports(folder: str | Path) -> dict[str, Report]:
    """The folder's reports by name, in the configuration's order.

    Errors, before any runs: a report without a file, a module without ``build``, a
    name that the catalogue has, settings or parameters that are not known.
    """
    folder = Path(folder)
    with (folder / CONFIG).open("rb") as f:
        entries = tomllib.load(f).get("reports", {})
    out = {}
    for name, entry in entries.items():
        if name in REPORTS:
            raise ValueError(f"report {name!r} is in the catalogue already")
        if not re.fullmatch(r"[\w-]+", name):
            raise ValueError(f"report name {name!r} has other characters than letters, digits, _ and -")
        if odd := set(entry) - FIELDS:
            raise ValueError(f"report {name!r}: unknown settings {', '.join(sorted(odd))}")
        frequency = entry.get("frequency", "hourly")
        if frequency not in {*FREQUENCY_SECONDS, "monthly"}:
            raise ValueError(f"report {name!r}: unknown frequency {frequency!r}")
        sql, module = folder / f"{name}.sql", folder / f"{name}.py"
        if sql.is_file():
            try:
                build = _from_sql(sql.read_text(encoding="utf-8"))
            except ValueError as e:
                raise ValueError(f"report {name!r}: {e}") from None
        elif module.is_file():
            build = getattr(_module(module), "build", None)
            if not callable(build):
                raise ValueError(f"report {name!r}: {module.name} has no build(tables, params)")
        else:
            raise ValueError(f"report {name!r} has neither {sql.name} nor {module.name}")
        starts = entry.get("starts")
        out[name] = Report(name, entry.get("title", name), frequency, build, dict(entry.get("labels", {})),
                           timeboxed=starts is not None, starts=None if starts is None else str(starts), source=entry.get("source", "el"))
    return out


def with_files(folder: str | Path) -> dict[str, Report]:
    """The catalogue and the folder's reports: a ``registry`` for ``run_report``, ``run_all`` and the runner."""
    return {**REPORTS, **load_reports(folder)}
