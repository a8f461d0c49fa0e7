"""Every operator bound to the driver's tables, each with an equivalent DuckDB query where SQL can say it."""

from atlas.queries import base


def load() -> dict[str, base.Query]:
    from atlas.queries import (  # noqa: F401
        aggregates,
        builders,
        filters,
        gates,
        joins,
        release,
        scalars,
        search,
        sources,
        spatial,
        sqlfunctions,
        telemetry,
    )

    return base.REGISTRY
