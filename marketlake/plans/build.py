"""The build job: silver, then gold, then checks."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Row

from marketlake import contracts
from marketlake.functions.records import as_json_text
from marketlake.operators.quality import require_pass, run_checks
from marketlake.plans.models import MODELS, Model
from marketlake.sinks.tables import publish_table
from marketlake.sources.catalog import table
from marketlake.sources.drift import scan_any_schema
from marketlake.sources.lake import Lake


@dataclass
class BuildResult:
    """The tables built, and one row per check, None if checks were skipped."""

    tables: list[str]
    checks: list[Row] | None


def select_models(select: str | None = None, exclude: str | None = None) -> list[Model]:
    """Models in the order they are built.

    A selection is a list of ``layer.*``, ``name``, ``layer.name`` or ``+name`` (with what it
    reads), separated by spaces; nothing selected means all.
    """
    chosen = set(MODELS) if select is None else _named(select)
    chosen -= _named(exclude) if exclude else set()
    ordered = sorted(chosen, key=lambda n: (_depth(MODELS[n]), list(MODELS).index(n)))
    return [MODELS[n] for n in ordered]


def _named(selection: str) -> set[str]:
    out: set[str] = set()
    for word in selection.split():
        name = word.removeprefix("+")
        matched = {
            m.name for m in MODELS.values() if name in (m.name, f"{m.layer}.{m.name}", f"{m.layer}.*")
        }
        if not matched:
            raise ValueError(f"selection {word!r} matches no model")
        out |= matched
        if word.startswith("+"):
            out |= {a for m in matched for a in _ancestors(MODELS[m])}
    return out


def _ancestors(model: Model) -> list[str]:
    if model.parent is None:
        return []
    return [model.parent, *_ancestors(MODELS[model.parent])]


def _depth(model: Model) -> int:
    return len(_ancestors(model))


def model_query(
    lake: Lake, model: Model, run_date: date | None = None, prefix: str = ""
) -> DataFrame:
    """A model's query over its stored input."""
    if model.parent is not None:
        parent = MODELS[model.parent]
        return model.query(table(lake.spark, f"{prefix}{parent.layer}", parent.name))
    # nested columns are wanted as JSON text only, so text and nested files read alike
    bronze = scan_any_schema(lake, model.source, as_json_text(model.bronze_contract))
    return model.query(bronze, run_date)


def build(
    lake: Lake,
    select: str | None = None,
    exclude: str | None = None,
    full_refresh: bool = False,
    run_date: date | None = None,
    test_select: list[str] | None = None,
    skip_checks: bool = False,
    prefix: str = "",
    variables: Mapping[str, str] | None = None,
) -> BuildResult:
    """Rebuild and register the selected models in order, then check them.

    Fails if a check fails; the error carries the result rows. ``variables`` gives the values
    that models read, by name; the one they have is ``run_date``. ``test_select`` names other models to check than the ones built;
    ``prefix`` goes before the database names, so that builds can live side by side.
    """
    if unknown := set(variables or ()) - {"run_date"}:
        raise ValueError(f"no model reads {', '.join(sorted(unknown))}")
    if variables:
        run_date = date.fromisoformat(variables["run_date"])
    built = select_models(select, exclude)
    tables = [
        publish_table(
            lake,
            model_query(lake, model, run_date, prefix),
            model.layer,
            model.name,
            database=f"{prefix}{model.layer}",
            full_refresh=full_refresh,
        )
        for model in built
    ]
    checks = check_tables(
        lake, test_select or [m.name for m in built], skip=skip_checks, prefix=prefix
    )
    return BuildResult(tables, None if checks is None else require_pass(checks))


def build_layer(lake: Lake, layer: str, **options) -> BuildResult:
    """Build one layer, without checks."""
    return build(lake, select=f"{layer}.*", skip_checks=True, **options)


def check_tables(
    lake: Lake, select: list[str] | None = None, skip: bool = False, prefix: str = ""
) -> DataFrame | None:
    """Check results of the stored models."""

    def read(name: str) -> DataFrame:
        return table(lake.spark, f"{prefix}{MODELS[name].layer}", name)

    return run_checks(read, contracts.CHECKS, select, skip)
