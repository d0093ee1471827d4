"""Record schemas, declared search settings and the result projections."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

INT_FIELDS = ("id", "points")
FLOAT_FIELDS = ("price",)
STRING_FIELDS = (
    "title",
    "description",
    "variety",
    "winery",
    "vineyard",
    "country",
    "province",
    "region_1",
    "region_2",
    "taster_name",
    "taster_twitter_handle",
)
FIELDS = INT_FIELDS + FLOAT_FIELDS + STRING_FIELDS

# Name under which a field arrives -> name under which it is kept. The incoming name wins
# when a record carries both.
ALIASES = {"designation": "vineyard"}

# A null is fine in every other field, but the key itself has to be there.
NOT_NULL = ("id", "points", "title")
# The fill rule supplies a value when this key is absent.
KEY_OPTIONAL = ("country",)

REVIEW = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("points", T.IntegerType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("description", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("variety", T.StringType()),
        T.StructField("winery", T.StringType()),
        T.StructField("vineyard", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("province", T.StringType()),
        T.StructField("region_1", T.StringType()),
        T.StructField("region_2", T.StringType()),
        T.StructField("taster_name", T.StringType()),
        T.StructField("taster_twitter_handle", T.StringType()),
        T.StructField("to_vectorize", T.StringType()),
        T.StructField("_extra", T.MapType(T.StringType(), T.StringType())),
    ]
)

QUARANTINE = T.StructType(
    [
        T.StructField("raw", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("input_file", T.StringType()),
    ]
)

# Columns each kind of question answers with.
HIT_COLUMNS = ("id", "country", "title", "description", "points", "price", "variety", "winery")
PLACE_COLUMNS = (
    "id",
    "country",
    "province",
    "title",
    "description",
    "points",
    "price",
    "variety",
    "winery",
)

NO_PRICE = "Not available"
UNKNOWN = "Unknown"


# The rules that rank hits, each breaking the ties of the one before.
RANK_RULES = ("words", "typo", "proximity", "attribute", "sort", "exactness", "points:desc")


@dataclass(frozen=True)
class SearchSpec:
    """Which attributes may be searched, filtered on, sorted by and shown."""

    searchable: tuple[str, ...]
    filterable: tuple[str, ...]
    sortable: tuple[str, ...]
    displayed: tuple[str, ...]
    stop_words: tuple[str, ...] = ()
    one_typo: int = 4
    two_typos: int = 9
    max_hits: int = 500
    max_facet_values: int = 100
    rules: tuple[str, ...] = RANK_RULES

    def check(self, *, search=(), filters=(), sort=(), show=()) -> None:
        """Refuse undeclared attributes before any plan is built."""
        for kind, asked, allowed in (
            ("searchable", search, self.searchable),
            ("filterable", filters, self.filterable),
            ("sortable", sort, self.sortable),
            ("displayed", show, self.displayed),
        ):
            unknown = [c for c in asked if c not in allowed]
            if unknown:
                raise ValueError(f"not {kind}: {', '.join(unknown)}")

    def cap(self, k: int) -> int:
        return min(k, self.max_hits)


# The ranked keyword profile's declared settings.
RANKED_SPEC = SearchSpec(
    searchable=(
        "title",
        "description",
        "country",
        "province",
        "variety",
        "region_1",
        "region_2",
        "taster_name",
    ),
    filterable=("price", "points", "country", "province", "variety"),
    sortable=("points", "price"),
    displayed=(
        "id",
        "points",
        "price",
        "title",
        "country",
        "province",
        "variety",
        "winery",
        "taster_name",
        "description",
    ),
    stop_words=("the", "a", "an", "of", "to", "in", "for", "on"),
    one_typo=4,
    two_typos=9,
    max_hits=500,
    max_facet_values=100,
    rules=RANK_RULES,
)

# Result sizes, index settings and the fields of the full-text index.
TOP_K = 5
DEFAULT_LIMIT = 25
FULLTEXT_FIELDS = ("title", "description", "variety")
VECTOR_DIM = 384
ANN_LISTS = 4
ANN_SUBVECTORS = 32
ANN_PROBES = 20
