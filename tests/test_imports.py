import importlib
import pkgutil

import viewtide


def test_every_module_imports():
    names = [m.name for m in pkgutil.walk_packages(viewtide.__path__, "viewtide.")]
    assert "viewtide.plans.streams" in names
    for name in names:
        importlib.import_module(name)


def test_stream_jobs_have_their_own_item_columns():
    from viewtide.plans import streams

    assert streams.ITEM_COLUMNS == ("title", "content_type", "genre_primary", "release_year")
    assert {"imdb_rating", "is_original", "rating"} <= set(streams.HEALTH_ITEM_COLUMNS)
    assert {"country", "subscription_plan"} <= set(streams.HEALTH_USER_COLUMNS)
