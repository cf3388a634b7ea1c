"""Explicit schemas of the six domain tables and of the event stream."""

from __future__ import annotations

from pyspark.sql.types import StructType


def fields(**types: str) -> StructType:
    """Nullable fields by name and type; unlike a DDL text, it needs no session."""
    schema = StructType()
    for name, kind in types.items():
        schema.add(name, kind)
    return schema


USERS = fields(
    user_id="string", email="string", first_name="string", last_name="string", age="double",
    gender="string", country="string", state_province="string", city="string",
    subscription_plan="string", subscription_start_date="date", is_active="boolean",
    monthly_spend="double", primary_device="string", household_size="integer",
    created_at="timestamp",
)

WATCH_HISTORY = fields(
    session_id="string", user_id="string", movie_id="string", watch_date="timestamp",
    device_type="string", watch_duration_minutes="double", progress_percentage="double",
    action="string", quality="string", location_country="string", is_download="boolean",
    user_rating="double",
)

#: One message of the event stream; dates arrive as text.
WATCH_EVENT = fields(
    session_id="string", user_id="string", movie_id="string", watch_date="string",
    device_type="string", watch_duration_minutes="double", progress_percentage="double",
    action="string", quality="string", location_country="string", is_download="boolean",
    user_rating="double", timestamp="string",
)


def movies_schema(original_flag: str = "is_original") -> StructType:
    """The catalogue schema; platforms name the "own production" flag differently."""
    named = dict(
        movie_id="string", title="string", content_type="string", genre_primary="string",
        genre_secondary="string", release_year="integer", duration_minutes="double",
        rating="string", language="string", country_of_origin="string", imdb_rating="double",
        production_budget="double", box_office_revenue="double", number_of_seasons="integer",
        number_of_episodes="integer", is_original="boolean", added_to_platform="date",
        content_warning="boolean",
    )
    return fields(**{original_flag if n == "is_original" else n: t for n, t in named.items()})


#: Column names and types, as the data cards give them. Other tables are inferred.
TABLE_SCHEMAS = {"users": USERS, "movies": movies_schema(), "watch_history": WATCH_HISTORY}

#: Columns that must be present for a row of each table to be usable.
CRITICAL_COLUMNS = {
    "users": ["user_id", "email"],
    "movies": ["movie_id", "title"],
    "watch_history": ["session_id", "user_id", "movie_id"],
    "recommendation_logs": ["user_id", "movie_id"],
    "reviews": ["user_id", "movie_id"],
    "search_logs": ["user_id"],
}

#: File and cleaned-table name of each domain table.
TABLE_FILES = {
    "users": "users.csv",
    "movies": "movies.csv",
    "watch_history": "watch_history.csv",
    "recommendation_logs": "recommendation_logs.csv",
    "reviews": "reviews.csv",
    "search_logs": "search_logs.csv",
}
CLEANED_NAMES = {
    "users": "Users",
    "movies": "Movies",
    "watch_history": "WatchHistory",
    "recommendation_logs": "RecommendationLogs",
    "reviews": "Reviews",
    "search_logs": "SearchLogs",
}

JOIN_KEYS = ("user_id", "movie_id", "session_id")
