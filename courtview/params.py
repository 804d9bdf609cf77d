"""Parameters of the audience analytics build.

Every threshold the reference hard-codes is a field here, so a binding can scale
it to its data without touching operator code.  ``as_of`` replaces the wall
clock the reference reads for its collection window and for video age.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from decimal import Decimal

# A rule is (label, title pattern or None, duration pattern or None); the first
# rule whose title pattern or duration pattern finds a match wins.
Rule = tuple[str, "str | None", "str | None"]

# ---------------------------------------------------------------------------
# The reference's classification rules, in the reference's order.
# Patterns are searched (not anchored) in the lower-cased, whitespace-squished
# title; the duration pattern is searched in the ISO-8601 duration text.
# ---------------------------------------------------------------------------
REFERENCE_CONTENT_RULES: tuple[Rule, ...] = (
    ("Shorts", "shorts|#shorts", "^PT[0-9]+S$"),
    ("Highlights/Recap", "highlight|best plays|recap|full season", None),
    ("Interview/Press", "interview|press conference|media availability", None),
    ("Behind the Scenes", "all-access|behind|practice|locker room|mic", None),
    ("Promo/Hype", "hype|trailer|promo", None),
)
REFERENCE_CONTENT_DEFAULT = "Other"

REFERENCE_THEME_RULES: tuple[Rule, ...] = (
    ("Playoff Stakes", "playoff|finals|ecf|round 1|series", None),
    ("Star Player", "steph|curry|lebron|luka|shai|jalen|tatum|jt|brunson", None),
    ("Rookie/Development", "rookie|draft|55th pick", None),
    ("Coach/Leadership", "coach|kerr|mazzulla|thibodeau", None),
    ("Team Identity", "comeback|not done|greatness|hype", None),
)
REFERENCE_THEME_DEFAULT = "General Team Content"

# The four monitoring priorities, in rank order, and their short
# labels as used by the dashboard's recode field (anything else -> "Standard").
PRIORITY_BOTH = "High Engagement / High Negative Sentiment"
PRIORITY_NEGATIVE = "High Negative Sentiment"
PRIORITY_ENGAGEMENT = "High Engagement"
PRIORITY_STANDARD = "Standard"
PRIORITY_ORDER = (PRIORITY_BOTH, PRIORITY_NEGATIVE, PRIORITY_ENGAGEMENT, PRIORITY_STANDARD)
PRIORITY_SHORT = {
    PRIORITY_BOTH: "High Eng. + High Neg.",
    PRIORITY_NEGATIVE: "High Neg. Sentiment",
    PRIORITY_ENGAGEMENT: "High Engagement",
}
PRIORITY_SHORT_DEFAULT = "Standard"
PRIORITY_SHORT_ORDER = ("High Eng. + High Neg.", "High Neg. Sentiment", "High Engagement", "Standard")

SENTIMENT_LABELS = ("Positive", "Neutral", "Negative")


@dataclass(frozen=True)
class Params:
    """Defaults are the reference's values; ``as_of`` has no default."""

    as_of: date
    start_date: date = date(2026, 4, 18)
    label_threshold: Decimal = Decimal("0.15")
    quantile: float = 0.90
    min_comments: int = 10
    min_views: int = 10_000
    min_group: int = 3
    top_n_per_team: int = 20
    list_cap: int = 100
    batch_size: int = 50
    top_titles: int = 5
    # apply the collection window (list cap per channel -> date window -> newest n per team) before staging,
    # as the reference's collection step does; the driver-table bindings stage every item instead
    apply_collection_window: bool = False
    content_rules: tuple[Rule, ...] = field(default=REFERENCE_CONTENT_RULES)
    content_default: str = REFERENCE_CONTENT_DEFAULT
    theme_rules: tuple[Rule, ...] = field(default=REFERENCE_THEME_RULES)
    theme_default: str = REFERENCE_THEME_DEFAULT


# ---------------------------------------------------------------------------
# Fixture parameters for the two bindings of the driver tables (FIXTURES.md).
# The reference's words never occur in the generated prose, so the content
# binding carries rules made of letter groups that separate whole documents
# (each matches roughly 5-15 % of them); the labels stay the reference's labels.
# ---------------------------------------------------------------------------
CONTENT_CONTENT_RULES: tuple[Rule, ...] = (
    ("Shorts", None, "^PT[0-9]+S$"),
    ("Highlights/Recap", "best|free", None),
    ("Interview/Press", "license|[0-9]", None),
    ("Behind the Scenes", "mic|avec", None),
    ("Promo/Hype", "ción|nicht", None),
)
CONTENT_THEME_RULES: tuple[Rule, ...] = (
    ("Playoff Stakes", "ungen|ado", None),
    ("Star Player", "pour |para ", None),
    ("Rookie/Development", " los | die ", None),
    ("Coach/Leadership", "avec|with the", None),
    ("Team Identity", "und ", None),
)
COMMERCE_CONTENT_RULES: tuple[Rule, ...] = (
    ("Shorts", None, "^PT[0-9]+S$"),
    ("Highlights/Recap", "automobile", None),
    ("Interview/Press", "building", None),
    ("Behind the Scenes", "furniture", None),
    ("Promo/Hype", "machinery", None),
)
COMMERCE_THEME_RULES: tuple[Rule, ...] = (
    ("Playoff Stakes", "urgent", None),
    ("Star Player", "high", None),
    ("Rookie/Development", "medium", None),
    ("Coach/Leadership", "not specified", None),
)

CONTENT_PARAMS = Params(
    as_of=date(2024, 2, 15),
    start_date=date(2024, 1, 1),
    min_comments=5,
    min_views=10,
    content_rules=CONTENT_CONTENT_RULES,
    theme_rules=CONTENT_THEME_RULES,
)

COMMERCE_PARAMS = Params(
    as_of=date(2002, 1, 1),
    start_date=date(1995, 1, 1),
    content_rules=COMMERCE_CONTENT_RULES,
    theme_rules=COMMERCE_THEME_RULES,
)

# The fixture lexicon of the content binding (word, value).
FIXTURE_LEXICON: tuple[tuple[str, str], ...] = (
    ("the", "0.25"), ("of", "-0.25"), ("and", "0.5"), ("in", "-0.5"),
    ("to", "0.4"), ("is", "-0.4"), ("that", "0.75"), ("on", "-0.75"),
    ("it", "0.8"), ("was", "-1"), ("for", "0.6"), ("by", "-0.6"),
    ("with", "1"), ("en", "-0.4"), ("la", "0.5"), ("ou", "-0.25"),
    ("de", "0.25"),
)
