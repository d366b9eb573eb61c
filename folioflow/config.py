"""Rules of all stages. Loaded once on the driver; thresholds enter plans as literals.

Fixed values: all thresholds, weights, costs, limits and keywords below.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TriageRules:
    native_density: float = 0.002
    native_image: float = 0.20
    scanned_chars: float = 20
    scanned_image: float = 0.60
    columns: int = 2
    column_balance: float = 0.55
    grid: float = 0.35
    figure: float = 0.45
    fallback_language: str = "und"
    fallback_confidence: float = 0.5
    domains: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "financial": ("balance", "invoice", "revenue", "tax"),
            "legal": ("agreement", "clause", "contract", "statute"),
            "technical": ("architecture", "api", "module", "protocol"),
            "medical": ("diagnosis", "patient", "treatment", "clinical"),
        }
    )


@dataclass(frozen=True)
class ExtractionRules:
    least_chars: float = 200
    least_density: float = 0.001
    most_image: float = 0.35
    weights: tuple[float, float, float, float] = (0.35, 0.35, 0.20, 0.10)
    accept: dict[str, float] = field(default_factory=lambda: {"fast_text": 0.70, "layout_aware": 0.75, "vision": 0.78})
    fast_cost: tuple[float, float] = (0.001, 0.0002)
    layout_cost: tuple[float, float] = (0.01, 0.001)
    vision_tokens: tuple[int, int] = (300, 1200)
    vision_per_1k: float = 0.006
    budget: float = 0.15
    handwriting_ids: tuple[str, ...] = ()


@dataclass(frozen=True)
class ChunkRules:
    chunk_tokens: int = 200
    list_tokens: int = 200
    table_rows: int = 20
    headings: tuple[str, ...] = ("heading",)


@dataclass(frozen=True)
class IndexRules:
    stopwords: tuple[str, ...] = ("section", "table", "figure", "document")
    entities: int = 8
    summary_chunks: int = 6


@dataclass(frozen=True)
class QueryRules:
    limit: int = 5
    most: int = 20
    terms: int = 4
    iterations: int = 4


@dataclass(frozen=True)
class Rules:
    triage: TriageRules = TriageRules()
    extraction: ExtractionRules = ExtractionRules()
    chunking: ChunkRules = ChunkRules()
    index: IndexRules = IndexRules()
    query: QueryRules = QueryRules()


def load_rules(path: str | None = None) -> Rules:
    """Rules from a YAML file with the sections above; the defaults without one."""
    if path is None:
        return Rules()
    import dataclasses

    import yaml

    told = yaml.safe_load(open(path, encoding="utf-8")) or {}
    rules = Rules()
    return dataclasses.replace(rules, **{k: dataclasses.replace(getattr(rules, k), **v) for k, v in told.items() if hasattr(rules, k)})
