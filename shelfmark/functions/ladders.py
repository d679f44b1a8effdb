"""Bucket ladders: ordered labels with upper bounds, as CASE expressions."""

from dataclasses import dataclass

from .text import quoted


@dataclass(frozen=True)
class Ladder:
    """Ascending steps ``(upper bound, label)`` and a label for what lies above.

    A value takes the first step whose bound it stays below (or reaches, when
    ``inclusive``). NULL has no step.
    """

    steps: tuple[tuple[float, str], ...]
    top: str
    inclusive: bool = False

    @property
    def labels(self) -> list[str]:
        return [label for _, label in self.steps] + [self.top]

    def _case(self, value: str, results: list[str]) -> str:
        compare = "<=" if self.inclusive else "<"
        steps = " ".join(f"WHEN {value} {compare} {bound!r}{'D' if isinstance(bound, float) else ''} THEN {result}"
                         for (bound, _), result in zip(self.steps, results))
        return f"CASE WHEN {value} IS NULL THEN NULL {steps} ELSE {results[-1]} END"

    def ordinal(self, value: str) -> str:
        """SQL for the number of the step that the SQL expression ``value`` takes."""
        return self._case(value, [str(i) for i in range(len(self.labels))])

    def label(self, value: str) -> str:
        """SQL for the label of the step that ``value`` takes."""
        return self._case(value, [quoted(label) for label in self.labels])


# ---- fixed values: bucket labels and bounds of the standard reports ----
PAGES = Ladder((
    (100, "Very Short (<100)"),
    (200, "Short (100-200)"),
    (300, "Medium-Short (200-300)"),
    (400, "Medium (300-400)"),
    (500, "Medium-Long (400-500)"),
    (700, "Long (500-700)"),
), "Very Long (700+)")

SERIES = Ladder((
    (0, "No Series"),
    (1, "Single Series"),
    (2, "2 Series"),
    (3, "3 Series"),
), "4+ Series", inclusive=True)

RATING = Ladder((
    (1.0, "0.0-1.0"),
    (2.0, "1.0-2.0"),
    (3.0, "2.0-3.0"),
    (4.0, "3.0-4.0"),
    (5.0, "4.0-5.0"),
), "5.0")

ENGAGEMENT = Ladder((
    (100, "Very Low (<100)"),
    (1000, "Low (100-1K)"),
    (10000, "Medium (1K-10K)"),
    (100000, "High (10K-100K)"),
    (1000000, "Very High (100K-1M)"),
), "Extremely High (1M+)")

QUALITY = Ladder((
    (3.0, "Low (< 3.0)"),
    (4.0, "Medium (3.0-4.0)"),
), "High (4.0+)")

REACH = Ladder((
    (100, "Low (<100)"),
    (1000, "Medium (100-1K)"),
    (10000, "High (1K-10K)"),
), "Very High (10K+)")

SHELVES = Ladder((
    (0, "No Shelves"),
    (5, "1-5 Shelves"),
    (10, "6-10 Shelves"),
    (20, "11-20 Shelves"),
    (50, "21-50 Shelves"),
), "50+ Shelves", inclusive=True)

SIMILAR = Ladder((
    (0, "No Similar Books"),
    (5, "1-5 Similar"),
    (10, "6-10 Similar"),
    (20, "11-20 Similar"),
    (50, "21-50 Similar"),
), "50+ Similar", inclusive=True)

SIMILAR_WIDE = Ladder((
    (0, "No Similar Books"),
    (10, "1-10 Similar"),
    (20, "11-20 Similar"),
    (50, "21-50 Similar"),
), "50+ Similar", inclusive=True)

KEYWORD_DENSITY = Ladder((
    (0, "0 keywords"),
    (2, "1-2 keywords"),
    (5, "3-5 keywords"),
    (10, "6-10 keywords"),
    (15, "11-15 keywords"),
), "15+ keywords", inclusive=True)
