"""Named transforms and chains of them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame

from ledgerflow.operators.enrich import ENRICHMENT_FIELDS, enrich_from_responses
from ledgerflow.operators.rows import DEFAULT_PII_FIELDS, filter_nulls, flatten_json, mask_pii
from ledgerflow.result import ChainResult


@dataclass(frozen=True)
class ChainOptions:
    """Settings the built-in transforms read; ``extra`` is for registered ones."""

    pii_fields: tuple[str, ...] = DEFAULT_PII_FIELDS
    responses: DataFrame | None = None
    response_key: str = "id"
    enrichment_fields: tuple[str, ...] = ENRICHMENT_FIELDS
    json_schema: str | None = None
    extra: dict = field(default_factory=dict)


# A transform takes the result so far and returns it with rows changed or marked as failed.
Transform = Callable[[ChainResult, ChainOptions], ChainResult]


def _enrich(result: ChainResult, options: ChainOptions) -> ChainResult:
    if options.responses is None:
        raise ValueError("enrich-from-api needs a table of landed responses")
    return enrich_from_responses(result, options.responses, options.response_key, options.enrichment_fields)


BUILT_IN: dict[str, Transform] = {
    "filter-nulls": lambda result, options: filter_nulls(result),
    "mask-pii": lambda result, options: mask_pii(result, options.pii_fields),
    "enrich-from-api": _enrich,
    "flatten-json": lambda result, options: flatten_json(result, options.json_schema),
}


class TransformRegistry:
    """Transforms by name; a name can be registered once."""

    def __init__(self, transforms: dict[str, Transform] | None = None):
        self._transforms = dict(BUILT_IN if transforms is None else transforms)

    def register(self, name: str, transform: Transform) -> None:
        if name in self._transforms:
            raise ValueError(f"transform {name!r} is already registered")
        self._transforms[name] = transform

    def names(self) -> list[str]:
        return sorted(self._transforms)

    def resolve(self, spec: str | None) -> list[Transform]:
        """A comma list to transforms, in order, repeats kept; blank is an empty chain."""
        names = [part.strip() for part in (spec or "").split(",")]
        unknown = [n for n in names if n and n not in self._transforms]
        if unknown:
            raise ValueError(f"unknown transform {unknown[0]!r}; available: {', '.join(self.names())}")
        return [self._transforms[n] for n in names if n]


def run_chain(
    df: DataFrame, spec: str | None, options: ChainOptions = ChainOptions(), registry: TransformRegistry | None = None
) -> ChainResult:
    """Apply a chain such as ``"filter-nulls,mask-pii"``.

    Accepted rows feed the next step; dead letters of all steps add up. The whole chain stays one plan over one scan.
    """
    transforms = (registry or TransformRegistry()).resolve(spec)
    return reduce(lambda result, step: step(result, options), transforms, ChainResult.start(df))
