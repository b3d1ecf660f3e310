"""Contract checks as columns: every row gets the names of the rules it breaks, then rows are routed."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierkeep.functions.measures import cents_to_decimal, safe_ratio
from tierkeep.functions.texts import digits_or_zero, pick
from tierkeep.sources.schemas import DEFAULT_NAMES, PayloadNames

# Allowed ranges.
PERCENT_RANGE = (0, 100)
SCORE_RANGE = (0, 9)
METACRITIC_RANGE = (0, 100)


@dataclass(frozen=True)
class Rule:
    """A named condition that holds for rows breaking the contract; NULL does not break it."""

    name: str
    broken: Column


def required(name: str, value: Column, when: Column | None = None) -> Rule:
    missing = value.isNull()
    return Rule(f"{name}_required", missing if when is None else when & missing)


def in_range(name: str, value: Column, limits: tuple[float, float]) -> Rule:
    return Rule(f"{name}_range", (value < limits[0]) | (value > limits[1]))


def at_least(name: str, value: Column, lowest: float = 0) -> Rule:
    return Rule(f"{name}_min", value < lowest)


def none_missing(name: str, array: Column, fields: Iterable[str]) -> Rule:
    """Every element of an array of structs has all the fields."""
    fields = tuple(fields)

    def lacks(item: Column) -> Column:
        found = item.isNull()
        for field in fields:
            found = found | item.getField(field).isNull()
        return found

    return Rule(f"{name}_complete", F.exists(array, lacks))


def violations(rules: Sequence[Rule]) -> Column:
    """Names of the broken rules, in rule order."""
    return F.array_compact(F.array(*[F.when(rule.broken, F.lit(rule.name)) for rule in rules]))


def checked(df: DataFrame, rules: Sequence[Rule], column: str = "violations") -> DataFrame:
    return df.withColumn(column, violations(rules))


def routed(df: DataFrame, column: str = "violations") -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows) of a checked frame.

    Each of the two is worked out from the frame; ``cut`` a frame that is costly to make.
    """
    clean = F.size(column) == 0
    return df.filter(clean).drop(column), df.filter(~clean)


def validated(succeeded: Column, broken: Column, error: Column) -> tuple[Column, Column]:
    """Status and message after validation: a broken contract turns a success into a failure."""
    clean = F.size(broken) == 0
    message = F.when(succeeded & ~clean, F.concat(F.lit("contract: "), F.concat_ws(", ", broken))).otherwise(error)
    return succeeded & clean, message


def key_rules(key: Column) -> list[Rule]:
    return [required("app_id", key), at_least("app_id", key, 1)]


def price_rules(price: Column) -> list[Rule]:
    """A price block may be absent (free items); a present one must be whole."""
    present = price.isNotNull()
    fields = ("currency", "initial", "final", "discount_percent")
    return [
        *[required(f"price_{f}", price[f], present) for f in fields],
        in_range("price_discount_percent", price["discount_percent"], PERCENT_RANGE),
    ]


def store_rules(item: Column, names: PayloadNames = DEFAULT_NAMES) -> list[Rule]:
    return [
        required("item_id", item[names.item_id]),
        required("name", item["name"]),
        required("type", item["type"]),
        *price_rules(item["price_overview"]),
        required("metacritic_score", item["metacritic"]["score"], item["metacritic"].isNotNull()),
        in_range("metacritic_score", item["metacritic"]["score"], METACRITIC_RANGE),
        none_missing("categories", item["categories"], ("id", "description")),
        none_missing("genres", item["genres"], ("id", "description")),
        none_missing("screenshots", item["screenshots"], ("id", "path_thumbnail", "path_full")),
    ]


def _text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def _flag(value: Column) -> Column:
    return F.coalesce(value, F.lit(False))


def _count(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


# Element layouts of the item's arrays.
ITEM_ARRAYS = {
    "categories": "array<struct<id: int, description: string>>",
    "genres": "array<struct<id: string, description: string>>",
    "screenshots": "array<struct<id: int, path_thumbnail: string, path_full: string>>",
}


def with_store_defaults(item: Column) -> Column:
    """The item with the contract's defaults filled in and the required age as a number."""
    texts = ("short_description", "detailed_description", "about_the_game", "header_image", "supported_languages")
    filled = item
    for field in texts:
        filled = filled.withField(field, _text(item[field]))
    for field in ("developers", "publishers"):
        filled = filled.withField(field, F.coalesce(item[field], F.array().cast("array<string>")))
    for field in ("categories", "genres", "screenshots"):
        filled = filled.withField(field, F.coalesce(item[field], F.array().cast(ITEM_ARRAYS[field])))
    platforms = F.struct(*[_flag(item["platforms"][p]).alias(p) for p in ("windows", "mac", "linux")])
    release = F.struct(
        _flag(item["release_date"]["coming_soon"]).alias("coming_soon"), _text(item["release_date"]["date"]).alias("date")
    )
    return (
        filled.withField("is_free", _flag(item["is_free"]))
        .withField("required_age", digits_or_zero(item["required_age"]))
        .withField("platforms", platforms)
        .withField("release_date", release)
    )


def store_derived(item: Column) -> dict[str, Column]:
    """Exact prices and plain name lists."""
    return {
        "initial_dollars": cents_to_decimal(item["price_overview"]["initial"]),
        "final_dollars": cents_to_decimal(item["price_overview"]["final"]),
        "genre_names": pick(item["genres"], "description"),
        "category_names": pick(item["categories"], "description"),
    }


def with_summary_defaults(summary: Column) -> Column:
    # in the declared order, so that the filled summary has the type of the answered one
    names = ("num_reviews", "review_score", "review_score_desc", "total_positive", "total_negative", "total_reviews")
    return F.struct(*[(_text if c == "review_score_desc" else _count)(summary[c]).alias(c) for c in names])


def summary_rules(summary: Column) -> list[Rule]:
    totals = ("total_positive", "total_negative", "total_reviews")
    return [
        in_range("review_score", summary["review_score"], SCORE_RANGE),
        *[at_least(t, summary[t]) for t in totals],
    ]


def summary_ratio(summary: Column) -> Column:
    return safe_ratio(summary["total_positive"], summary["total_reviews"])


AUTHOR_COUNTERS = (
    "num_games_owned",
    "num_reviews",
    "playtime_forever",
    "playtime_last_two_weeks",
    "playtime_at_review",
)


def review_rules(review: Column, names: PayloadNames = DEFAULT_NAMES) -> list[Rule]:
    author = review["author"]
    needed = ("recommendationid", "timestamp_created", "timestamp_updated", "voted_up")
    return [
        *[required(f, review[f]) for f in needed],
        required("author_id", author[names.author_id]),
        *[at_least(f, author[f]) for f in AUTHOR_COUNTERS],
        *[at_least(f, review[f]) for f in ("votes_up", "votes_funny", "comment_count")],
    ]


def review_derived(review: Column) -> dict[str, Column]:
    return {
        "created_at": F.timestamp_seconds(review["timestamp_created"]),
        "updated_at": F.timestamp_seconds(review["timestamp_updated"]),
        "playtime_hours": _count(review["author"]["playtime_at_review"]) / 60,
    }


def single_reviews(records: DataFrame, names: PayloadNames = DEFAULT_NAMES) -> DataFrame:
    """One row per review out of review payloads, checked and with derived fields."""
    review = F.col("review")
    rows = records.select(
        F.col("request_params.app_id").alias("app_id"), F.explode("raw_data.reviews").alias("review")
    )
    return checked(rows, review_rules(review, names)).withColumns(review_derived(review))


def player_rules(payload: Column) -> list[Rule]:
    return [
        required("player_count", payload["player_count"]),
        at_least("player_count", payload["player_count"]),
        required("result", payload["result"]),
    ]
