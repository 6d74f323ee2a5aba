"""The declared data tests of the model graph (55 checks)."""

from __future__ import annotations

from rankforge.operators.quality import Check


def _nn_unique(model: str, cols: list[str]) -> list[Check]:
    out = []
    for c in cols:
        out.append(Check(f"not_null_{model}_{c}", model, "not_null", {"col": c}))
        out.append(Check(f"unique_{model}_{c}", model, "unique", {"col": c}))
    return out


def _fk(model: str, col: str, to: str, field: str) -> list[Check]:
    return [
        Check(f"not_null_{model}_{col}", model, "not_null", {"col": col}),
        Check(f"relationships_{model}_{col}__{to}", model, "relationships",
              {"col": col, "to": to, "field": field}),
    ]


# Bounds, patterns and sets the tests assert.
DECLARED_CHECKS: list[Check] = [
    # staging
    Check("compound_unique_stg_ranked_list", "stg_ranked_list", "compound_unique",
          {"cols": ["published_date", "rank"]}),
    Check("row_count_stg_ranked_list", "stg_ranked_list", "row_count", {"min": 15, "max": 5000}),
    Check("expect_not_null_stg_ranked_list_published_date", "stg_ranked_list", "not_null",
          {"col": "published_date"}),
    Check("between_stg_ranked_list_rank", "stg_ranked_list", "between", {"col": "rank", "min": 1, "max": 15}),
    Check("row_count_stg_volumes_search", "stg_volumes_search", "row_count", {"min": 15, "max": 3000}),
    Check("regex_stg_volumes_search_isbn13_clean", "stg_volumes_search", "regex",
          {"col": "isbn13_clean", "pattern": "^[0-9]{13}$"}),
    Check("expect_not_null_stg_volumes_search_isbn13_clean", "stg_volumes_search", "not_null",
          {"col": "isbn13_clean"}),
    Check("expect_not_null_stg_volumes_search_gbooks_id", "stg_volumes_search", "not_null",
          {"col": "gbooks_id"}),
    Check("row_count_stg_pageviews", "stg_pageviews", "row_count", {"min": 1500, "max": 200000}),
    Check("between_stg_pageviews_views", "stg_pageviews", "between", {"col": "views", "min": 0}),
    Check("in_set_stg_pageviews_granularity", "stg_pageviews", "in_set",
          {"col": "granularity", "values": ["daily"]}),
    # dimensions
    *_nn_unique("dim_book", ["book_key", "book_nk"]),
    *_nn_unique("dim_author", ["author_key", "author_name_norm"]),
    *_nn_unique("dim_week", ["week_key", "week_date"]),
    *_nn_unique("dim_date", ["date_key", "date_day"]),
    # bridge and facts
    *_fk("bridge_book_author", "book_key", "dim_book", "book_key"),
    *_fk("bridge_book_author", "author_key", "dim_author", "author_key"),
    *_fk("fct_weekly_rank", "week_key", "dim_week", "week_key"),
    *_fk("fct_weekly_rank", "book_key", "dim_book", "book_key"),
    *_fk("fct_pageviews_daily", "author_key", "dim_author", "author_key"),
    *_fk("fct_pageviews_daily", "date_key", "dim_date", "date_key"),
    *_fk("fct_catalogue_snapshot", "book_key", "dim_book", "book_key"),
    *_fk("fct_catalogue_snapshot", "snapshot_date_key", "dim_date", "date_key"),
    *_fk("fct_author_views_7d", "author_key", "dim_author", "author_key"),
    *_fk("fct_author_views_7d", "week_key", "dim_week", "week_key"),
    *_fk("fct_book_views_7d", "book_key", "dim_book", "book_key"),
    *_fk("fct_book_views_7d", "week_key", "dim_week", "week_key"),
    # wide table
    Check("compound_unique_weekly_scorecard", "weekly_scorecard", "compound_unique",
          {"cols": ["published_date", "rank"]}),
    Check("row_count_weekly_scorecard", "weekly_scorecard", "row_count", {"min": 15, "max": 3000}),
    Check("expect_not_null_weekly_scorecard_published_date", "weekly_scorecard", "not_null",
          {"col": "published_date"}),
    Check("between_weekly_scorecard_views_7d", "weekly_scorecard", "between", {"col": "views_7d", "min": 0}),
]

assert len(DECLARED_CHECKS) == 55, len(DECLARED_CHECKS)
