"""The model graph: raw tables -> staging -> intermediate -> marts.

``ModelGraph`` builds each model once, lazily, from the four raw frames, so
one Python object per model is shared by all of its consumers and Catalyst
sees the whole chain. ``build`` runs the graph in dependency order and
materialises the marts as tables (written to a shared folder and re-read, so
downstream models read files rather than re-running lineage), then runs the
declared checks.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from rankforge.operators.quality import run_checks
from rankforge.plans import intermediate as I
from rankforge.plans import marts as M
from rankforge.plans import staging as S
from rankforge.sources.io import latest_landing

# What each model reads (the model dependency graph).
DEPENDS = {
    "stg_ranked_list": [], "stg_volumes_search": [], "stg_volumes_isbn": [], "stg_pageviews": [],
    "best_volume_search": ["stg_volumes_search"],
    "best_volume_isbn": ["stg_volumes_isbn"],
    "wiki_author_map": ["stg_pageviews"],
    "dim_week": ["stg_ranked_list"],
    "book_keys": ["stg_ranked_list", "stg_volumes_search"],
    "fct_pageviews_daily": ["stg_pageviews"],
    "author_parse": ["book_keys", "best_volume_search", "stg_ranked_list"],
    "dim_book": ["book_keys", "best_volume_isbn", "best_volume_search", "stg_ranked_list"],
    "fct_weekly_rank": ["stg_ranked_list", "book_keys"],
    "fct_catalogue_snapshot": ["best_volume_search", "book_keys"],
    "dim_author": ["author_parse", "wiki_author_map"],
    "dim_date": ["stg_pageviews", "stg_ranked_list", "fct_catalogue_snapshot"],
    "bridge_book_author": ["author_parse"],
    "fct_author_views_7d": ["stg_pageviews", "dim_week"],
    "fct_book_views_7d": ["bridge_book_author", "fct_author_views_7d", "dim_week"],
    "weekly_scorecard": ["fct_weekly_rank", "dim_week", "dim_book", "bridge_book_author",
                         "fct_author_views_7d"],
}


def build_levels(names=None) -> list[list[str]]:
    """Group models into levels; every model's inputs are in earlier levels."""
    names = list(names or DEPENDS)
    level: dict[str, int] = {}

    def lv(n):
        if n not in level:
            level[n] = 1 + max((lv(d) for d in DEPENDS[n]), default=-1)
        return level[n]

    for n in names:
        lv(n)
    out: list[list[str]] = [[] for _ in range(max(level.values()) + 1)]
    for n in DEPENDS:
        if n in level:
            out[level[n]].append(n)
    return [grp for grp in out if grp]


# Build order (each model after everything it reads).
MODEL_ORDER = [
    "stg_ranked_list", "stg_volumes_search", "stg_volumes_isbn", "stg_pageviews",
    "best_volume_search", "best_volume_isbn", "wiki_author_map", "dim_week",
    "book_keys", "fct_pageviews_daily",
    "author_parse", "dim_book", "fct_weekly_rank", "fct_catalogue_snapshot",
    "dim_author", "dim_date",
    "bridge_book_author", "fct_author_views_7d",
    "fct_book_views_7d",
    "weekly_scorecard",
]

# Models read by three or more downstream models. The lazy graph persists
# them (memory, spilling to disk) so one query computes each once; a lost
# block is recomputed from lineage. The page-view staging model is left out
# on purpose: it is the one input that grows with traffic, and its consumers
# only need a scan each.
SHARED_MODELS = {"stg_ranked_list", "listed_volumes", "book_keys", "author_parse", "dim_week"}

# Models materialised as tables by ``build`` (the rest stay views).
TABLE_MODELS = {
    "dim_author", "dim_book", "dim_week", "dim_date", "bridge_book_author",
    "fct_weekly_rank", "fct_catalogue_snapshot", "fct_pageviews_daily",
    "fct_author_views_7d", "fct_book_views_7d", "weekly_scorecard",
}


class ModelGraph:
    """All 20 models over one set of raw frames.

    ``raw`` maps ``ranked_list``, ``catalogue_search``, ``catalogue_isbn``,
    ``pageviews`` to DataFrames. ``as_of`` stands in for "today" in the
    calendar. ``strip_decimal``/``collapse_ws`` switch on the intended
    (rather than the reference's literal) text clean-up;
    ``null_authors_as_text`` reproduces the reference's phantom "null" author.
    ``dedup_latest`` keeps the latest landing of rows that were landed again;
    by default they count again, as the append-only landing has them.
    ``wide_sums`` reads and sums views in 38 digits, for totals (or, landed as decimals, views) that 64 bits don't hold.
    ``on_malformed="fail"`` stops at a catalogue document that is no JSON, which has NULL fields otherwise.
    """

    def __init__(self, raw: dict[str, DataFrame], as_of: str | _dt.date,
                 strip_decimal: bool = False, collapse_ws: bool = False,
                 reuse_shared: bool = True, null_authors_as_text: bool = False,
                 dedup_latest: bool = False, wide_sums: bool = False,
                 on_malformed: str = "null"):
        self.raw = {n: latest_landing(df, n) for n, df in raw.items()} if dedup_latest else raw
        self.null_authors_as_text = null_authors_as_text
        self.as_of = as_of
        self.wide_sums = wide_sums
        self.on_malformed = on_malformed
        self.strip_decimal = strip_decimal
        self.collapse_ws = collapse_ws
        self.reuse_shared = reuse_shared
        self._override: dict[str, DataFrame] = {}
        self._persisted: list[DataFrame] = []

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._override:
            return self._override[name]
        df = getattr(self, name)
        if self.reuse_shared and name in SHARED_MODELS and not df.is_cached:
            df = df.persist(StorageLevel.MEMORY_AND_DISK)
            self._persisted.append(df)
        return df

    def release(self) -> None:
        """Unpersist the shared models (for long-lived sessions running many graphs)."""
        while self._persisted:
            self._persisted.pop().unpersist()

    def replace(self, name: str, df: DataFrame) -> None:
        """Swap a model for its materialised copy (used by ``build``)."""
        self._override[name] = df

    def _m(self, name):
        return self[name]

    # staging
    @cached_property
    def stg_ranked_list(self):
        return S.stg_ranked_list(self.raw["ranked_list"])

    @cached_property
    def stg_volumes_search(self):
        return S.stg_volumes(self.raw["catalogue_search"], self.on_malformed)

    @cached_property
    def told_volumes_search(self):
        """The staged volumes with ``has_isbn_match``, from the same parse."""
        own = "stg_volumes_search" in self._override
        parsed = self._m("stg_volumes_search") if own else S.parse_volumes(self.raw["catalogue_search"], self.on_malformed)
        return I.with_isbn_match(parsed).select(*self._m("stg_volumes_search").columns, "has_isbn_match")

    @cached_property
    def stg_volumes_isbn(self):
        return S.stg_volumes(self.raw["catalogue_isbn"], self.on_malformed)

    @cached_property
    def stg_pageviews(self):
        return S.stg_pageviews(self.raw["pageviews"], self.wide_sums)

    # intermediate
    @cached_property
    def best_volume_search(self):
        # Built on the parse that also yields the identifier list, so each
        # document is parsed once (the staging model's columns plus one).
        # Written volumes keep what the parse told about their ISBN.
        if "stg_volumes_search" in self._override:
            return I.best_volume(self._override.get("told_volumes_search", self._m("stg_volumes_search")), match_isbn=True)
        return I.best_volume(S.parse_volumes(self.raw["catalogue_search"], self.on_malformed).drop("__malformed"), match_isbn=True)

    @cached_property
    def listed_volumes(self):
        """What the marts read of the best volumes: no JSON document, so the
        shared copy is narrow and documents are parsed for the fields read."""
        return I.narrow_volumes(self._m("best_volume_search"), self.null_authors_as_text)

    @cached_property
    def best_volume_isbn(self):
        return I.best_volume(self._m("stg_volumes_isbn"), match_isbn=False)

    @cached_property
    def book_keys(self):
        # Only the catalogue's ISBN set matters: a one-column scan of the staged
        # catalogue, no JSON parsing and no ranking of volumes.
        return I.book_keys(self._m("stg_ranked_list"), self._m("stg_volumes_search"),
                           self.strip_decimal)

    @cached_property
    def author_parse(self):
        return I.author_parse(self._m("book_keys"), self._m("listed_volumes"),
                              self._m("stg_ranked_list"), self.collapse_ws)

    @cached_property
    def wiki_author_map(self):
        return I.wiki_author_map(self._m("stg_pageviews"), self.collapse_ws)

    # marts
    @cached_property
    def dim_author(self):
        return M.dim_author(self._m("author_parse"), self._m("wiki_author_map"))

    @cached_property
    def dim_book(self):
        return M.dim_book(self._m("book_keys"), self._m("best_volume_isbn"),
                          self._m("listed_volumes"), self._m("stg_ranked_list"),
                          self.strip_decimal)

    @cached_property
    def dim_week(self):
        return M.dim_week(self._m("stg_ranked_list"))

    @cached_property
    def dim_date(self):
        return M.dim_date(self._m("stg_pageviews"), self._m("stg_ranked_list"),
                          self._m("fct_catalogue_snapshot"), self.as_of)

    @cached_property
    def bridge_book_author(self):
        # Keys derived from the name (see the function); the dimension join
        # variant gives the same rows.
        return M.bridge_book_author(self._m("author_parse"))

    @cached_property
    def fct_weekly_rank(self):
        return M.fct_weekly_rank(self._m("stg_ranked_list"), self._m("book_keys"), self.strip_decimal)

    @cached_property
    def fct_catalogue_snapshot(self):
        return M.fct_catalogue_snapshot(self._m("listed_volumes"), self._m("book_keys"))

    @cached_property
    def fct_pageviews_daily(self):
        return M.fct_pageviews_daily(self._m("stg_pageviews"), collapse_ws=self.collapse_ws)

    @cached_property
    def fct_author_views_7d(self):
        # Views summed per (article, day) before the key is derived (see
        # author_day_views); the same sums as aggregating the daily fact.
        return M.fct_author_views_7d(M.author_day_views(self._m("stg_pageviews"), self.collapse_ws, self.wide_sums),
                                     None, self._m("dim_week"), wide=self.wide_sums)

    @cached_property
    def fct_book_views_7d(self):
        return M.fct_book_views_7d(self._m("bridge_book_author"), self._m("fct_author_views_7d"), self.wide_sums, self._m("dim_week"))

    @cached_property
    def weekly_scorecard(self):
        return M.weekly_scorecard(self._m("fct_weekly_rank"), self._m("dim_week"),
                                  self._m("dim_book"), bridge=self._m("bridge_book_author"),
                                  author_views=self._m("fct_author_views_7d"), wide=self.wide_sums)


# How tables are laid out: keys that unique checks group by and that the
# scorecard joins on are buckets; no key of these tables can hold a third of
# the rows. The wide table is partitioned by week; the calendar is sorted.
BUCKETS = {"book_keys": ["book_key"], "dim_book": ["book_key"], "fct_weekly_rank": ["book_key"], "bridge_book_author": ["book_key"],
           "dim_author": ["author_key"], "fct_author_views_7d": ["author_key"]}
PARTITIONS = {"weekly_scorecard": ["published_date"]}
SORTED = {"dim_date": ["date_day"], "dim_week": ["week_date"]}
# Models whose files also hold columns that spare later models a parse; their tables are read without them.
TOLD = {"stg_volumes_search": "told_volumes_search"}


def build(graph: ModelGraph, out_root: str | None = None, checks=None,
          materialize_all: bool = False, threads: int = 4, source: dict | None = None,
          commit_failed: bool = True) -> tuple[dict[str, DataFrame], DataFrame]:
    """Run the graph level by level and materialise models, then run the checks.

    With ``out_root`` (a shared folder: the warehouse path, never a
    machine-local one) table models become a new version of the warehouse there
    (:class:`rankforge.sources.warehouse.Warehouse`): readers keep the version before until all tables are
    written and checked, and a build that fails changes nothing. Without it, a warehouse under the
    cluster's ``spark.checkpoint.dir`` is used. ``materialize_all`` also materialises the view
    models. Either way every model is computed once and downstream models
    read it back instead of re-running its lineage, which also keeps the
    check plans small. Models of one level do not read each other, so up to
    ``threads`` of them run as concurrent Spark jobs.

    Checks that look at rows one by one, and row counts, are taken from the rows while they are written; the
    others read the written tables. ``source`` (raw, format, options) is kept with the version, so that later
    sessions can read the models that stay views. ``commit_failed=False`` leaves a version with failing checks uncommitted.
    Returns the models and the check summary.
    """
    import uuid
    from concurrent.futures import ThreadPoolExecutor

    from rankforge.operators.quality import observed_aggregates
    from rankforge.plans.checks import DECLARED_CHECKS
    from rankforge.session import scratch_path
    from rankforge.sources.warehouse import Warehouse

    checks = checks if checks is not None else DECLARED_CHECKS
    spark = next(iter(graph.raw.values())).sparkSession
    house = Warehouse(spark, out_root or scratch_path(spark, f"warehouse-{uuid.uuid4().hex[:12]}"))
    version, entries, observed = house.begin(), {}, {}

    def materialise(name: str):
        more = graph[TOLD[name]] if name in TOLD else None
        return name, house.write(version, name, graph[name] if more is None else more, PARTITIONS.get(name, ()), BUCKETS.get(name, ()), SORTED.get(name, ()),
                                 observe=observed_aggregates(name, checks), columns=graph[name].columns)

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        for level in build_levels(MODEL_ORDER):
            todo = [n for n in level if materialize_all or n in TABLE_MODELS]
            # Resolve the lazy frames on this thread first (plan construction
            # is not thread-safe); only the Spark jobs run concurrently.
            for n in todo:
                graph[n], graph[TOLD.get(n, n)]
            for name, (df, entry, seen) in pool.map(materialise, todo):
                graph.replace(name, df.select(*graph[name].columns))
                if name in TOLD:
                    graph.replace(TOLD[name], df)
                entries[name] = entry
                observed |= seen
    models = {n: graph[n] for n in MODEL_ORDER}
    summary = run_checks(models, checks, observed)
    if commit_failed or summary.where("failures > 0").isEmpty():
        house.commit(version, entries, source=source)
    return models, summary
