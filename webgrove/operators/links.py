"""Link extraction.  Links stay an array inside their page's row until the end,
so the whole family is narrow and works on streams."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgrove.functions import urls
from webgrove.functions.process import list_function
from webgrove.functions.text import has_nofollow, jvm_pattern, strip_blanks
from webgrove.operators.parse import _parse
from webgrove.operators.rows import explode_structs
from webgrove.operators.select import NODES, let, node_text

# Extensions that are not followed unless the caller says otherwise.
DENIED_EXTENSIONS = (
    "7z 7zip bz2 rar tar tar.gz xz zip"
    " mng pct bmp gif jpg jpeg png pst psp tif tiff ai drw dxf eps ps svg cdr ico webp"
    " mp3 wma ogg wav ra aac mid au aiff"
    " 3gp asf asx avi mov mp4 mpg qt rm swf wmv m4a m4v flv webm"
    " xls xlsm xlsx xltm xltx potm potx ppt pptm pptx pps doc docb docm docx dotm dotx odt ods odg odp"
    " css pdf exe bin rss dmg iso apk jar sh rb js hta bat cpl msi msp py"
).split()

SCHEMES = ("http", "https", "file", "ftp")      # fixed values

Strings = str | Iterable[str]
Patterns = str | re.Pattern[str] | Iterable[str | re.Pattern[str]]


def _list(value: Patterns | None) -> tuple:
    """A string or pattern is a list of one."""
    if value is None:
        return ()
    return (value,) if isinstance(value, (str, re.Pattern)) else tuple(value)


@dataclass(frozen=True)
class LinkOptions:
    """The keyword arguments of ``extract_links``."""

    allow: Patterns = ()
    deny: Patterns = ()
    allow_domains: Strings = ()
    deny_domains: Strings = ()
    tags: Strings = ("a", "area")
    attrs: Strings = ("href",)
    canonicalize: bool = False
    unique: bool = True
    process_value: Callable | None = None
    deny_extensions: Strings | None = None
    strip: bool = True

    def __post_init__(self) -> None:
        for name in ("allow", "deny", "allow_domains", "deny_domains", "tags", "attrs"):
            object.__setattr__(self, name, _list(getattr(self, name)))
        denied = DENIED_EXTENSIONS if self.deny_extensions is None else self.deny_extensions
        object.__setattr__(self, "deny_extensions", _list(denied))
        for pattern in (*self.allow, *self.deny):
            jvm_pattern(pattern)

    @property
    def scan(self) -> tuple:
        """What decides the resolved candidates, before any filter."""
        return self.tags, self.attrs, self.strip, self.process_value


NameTest = Strings | Callable[[Column], Column]


def candidates(tags: NameTest = ("a", "area"), attrs: NameTest = ("href",)) -> Column:
    """Every matching (element, attribute), in document then attribute order:
    ``array<struct<pre,attr,value,text,nofollow>>``.

    ``tags`` and ``attrs`` are names, or functions of a name Column.
    """
    tag_test = tags if callable(tags) else lambda t: t.isin(*_list(tags))
    attr_test = attrs if callable(attrs) else lambda a: a.isin(*_list(attrs))
    found = F.filter(F.col(NODES), lambda n: n["tag"].isNotNull() & tag_test(n["tag"]))

    def of_element(n: Column) -> Column:
        once = F.struct(node_text(n).alias("text"), has_nofollow(n["attrs"]["rel"]).alias("nofollow"))
        return let(once, lambda own: F.transform(F.filter(n["attr_names"], attr_test), lambda a: F.struct(
            n["pre"].alias("pre"),
            a.alias("attr"),
            n["attrs"][a].alias("value"),
            own["text"].alias("text"),
            own["nofollow"].alias("nofollow"),
        )))

    return F.flatten(F.transform(found, of_element))


def iter_links(docs: DataFrame, tags=("a", "area"), attrs=("href",)) -> DataFrame:
    """The raw scan: ``page_id, pos, pre, attr, value, text, nofollow``, nothing resolved."""
    return explode_structs(docs, candidates(tags, attrs), keep=("page_id",))


def resolve(docs: DataFrame, scan: tuple, name: str) -> DataFrame:
    """Add ``name``: resolved candidates as ``array<struct<url,text,nofollow>>``."""
    tags, attrs, strip, process_value = scan
    work = docs.withColumn("_raw", F.filter(candidates(tags, attrs), lambda c: c["value"].isNotNull()))
    values = F.transform("_raw", lambda c: strip_blanks(c["value"])) if strip else F.col("_raw.value")
    if process_value is None:
        # Values that plain functions resolve stay here; the others go to Python.
        work = work.withColumns({"_values": values, "_origin": urls.clean_origin(F.col("base_url"))})
        work = work.withColumn("_done", F.transform("_values", lambda v: urls.settled(v, F.col("_origin"))))
        work = work.withColumn("_hard", F.expr("transform(_values, (v, i) -> IF(get(_done, i) IS NULL, v, NULL))"))
        work = work.withColumn("_urls", urls.resolve_urls("base_url", "url", F.col("_hard")))
        work = work.withColumn("_urls", F.expr("transform(_urls, (u, i) -> coalesce(get(_done, i), u))")).drop(
            "_values", "_origin", "_done", "_hard")
    elif apply := list_function(process_value):
        work = work.withColumn("_urls", urls.process_urls(apply)("base_url", "url", values))
    else:
        work = work.withColumn("_urls", urls.join_urls("base_url", values))
        processed = F.transform("_urls", lambda u: F.when(u.isNotNull(), process_value(u)))
        work = work.withColumn("_urls", urls.finish_urls("url", processed))
    # The URLs come from Python, so they stay a column of their own: see task_udf.
    return work.withColumn(name, F.expr("""filter(
        transform(_raw, (c, i) -> struct(get(_urls, i) AS url, c.text AS text, c.nofollow AS nofollow)),
        x -> x.url IS NOT NULL)""")).drop("_raw", "_urls")


def first_per_key(links: str, key: str) -> str:
    """SQL for: keep the first link ``x`` of each ``key``, order kept.

    Sorting by key and place and keeping each run's head takes two sorts where
    comparing all pairs would be quadratic in a page's links.
    """
    return f"""transform(
        array_sort(transform(
            get(transform(array(array_sort(transform({links}, (x, i) -> struct({key} AS key, i AS at, x AS link)))),
                s -> filter(s, (y, j) -> j = 0 OR NOT (get(s, j - 1).key <=> y.key))), 0),
            z -> struct(z.at AS at, z.link AS link))),
        z -> z.link)"""


def allowed(url: Column, o: LinkOptions) -> Column:
    """Scheme, pattern, domain and extension tests; each looks at the URL alone."""
    test = url.rlike(f"^({'|'.join(SCHEMES)})://")
    if o.allow:
        test &= reduce(or_, [url.rlike(jvm_pattern(p)) for p in o.allow])
    if o.deny:
        test &= ~reduce(or_, [url.rlike(jvm_pattern(p)) for p in o.deny])
    if o.allow_domains:
        test &= in_domains(urls.netloc(url), o.allow_domains)
    if o.deny_domains:
        test &= ~in_domains(urls.netloc(url), o.deny_domains)
    if o.deny_extensions:
        test &= ~has_extension(url, o.deny_extensions)
    return test


def in_domains(name: Column, domains: Strings) -> Column:
    """``name`` is one of ``domains`` or below one of them."""
    domains = [d.lower() for d in _list(domains)]
    return F.exists(urls.host_suffixes(name), lambda s: s.isin(*domains))


def has_extension(url: Column, extensions: Strings) -> Column:
    """The path ends in one of the extensions; a name such as ``tar.gz`` is one extension."""
    names = "|".join(re.escape(e.lower()) for e in _list(extensions))
    return F.lower(urls.path(url)).rlike(rf"\.(?:{names})$")


def with_links(docs: DataFrame, name: str = "links", **options) -> DataFrame:
    """Add the page's links as ``array<struct<url,text,nofollow>>``."""
    o = LinkOptions(**options)
    return _finish(resolve(docs, o.scan, name), name, o)


def _finish(work: DataFrame, name: str, o: LinkOptions) -> DataFrame:
    """De-duplicate, then filter, then canonicalise where asked."""
    if not o.canonicalize:
        links = F.expr(first_per_key(name, "x.url")) if o.unique else F.col(name)
        return work.withColumn(name, F.filter(links, lambda x: allowed(x["url"], o)))
    # One key for equal URLs; the first wins, is filtered as written, then rewritten.
    # Usual URLs are rewritten here, the others in Python.
    work = work.withColumn("_plain", F.transform(f"{name}.url", lambda u: F.when(urls.is_plain(u), urls.canonical_plain(u))))
    hard = F.expr(f"transform({name}.url, (u, i) -> IF(get(_plain, i) IS NULL, u, NULL))")
    work = work.withColumn("_canonical", urls.canonical_urls(hard))
    work = work.withColumn("_canonical", F.expr("transform(_canonical, (c, i) -> coalesce(get(_plain, i), c))")).drop("_plain")
    keyed = f"transform({name}, (x, i) -> struct(x AS link, get(_canonical, i).key AS key, get(_canonical, i).url AS url))"
    links = F.expr(first_per_key(keyed, "x.key") if o.unique else keyed)
    work = work.withColumn(name, F.filter(links, lambda x: allowed(x["link"]["url"], o)))
    rewritten = f"transform({name}, x -> struct(x.url AS url, x.link.text AS text, x.link.nofollow AS nofollow))"
    return work.withColumn(name, F.expr(first_per_key(rewritten, "x.url") if o.unique else rewritten)).drop("_canonical")


def explode_links(docs: DataFrame, name: str = "links", *, keep: Iterable[str] = ("page_id",)) -> DataFrame:
    return explode_structs(docs, name, keep=keep)


def extract_links(docs: DataFrame, *, keep: Iterable[str] = ("page_id",), **options) -> DataFrame:
    """``docs`` -> ``page_id, pos, url, text, nofollow``, one row per link.

    Options: ``allow``, ``deny`` (patterns searched in the URL), ``allow_domains``,
    ``deny_domains``, ``tags``, ``attrs``, ``canonicalize``, ``unique``,
    ``process_value``, ``deny_extensions`` and ``strip``.

    ``process_value`` maps a link's URL, joined with the base, to another one; null or None
    drops the link.  It is a function of a Column, a function of a string, or a scalar UDF
    (plain, pandas, Arrow) over one string; see ``functions.process.list_function``.
    """
    return explode_links(with_links(docs, **options), keep=keep)


def links_from_pages(pages: DataFrame, *, keep: Iterable[str] = ("page_id",), partitions: int | None = None, **options) -> DataFrame:
    """Like ``extract_links``, from pages.

    Only elements a link can come from leave the parse, and no markup is built.
    """
    o = LinkOptions(**options)
    carry = [c for c in keep if c not in ("page_id", "url")]
    docs = _parse(pages, markup=False, carry=tuple(carry), partitions=partitions, only_tags=o.tags)
    if "url" in keep:
        docs = docs.withColumn("page_url", F.col("url"))
        keep = ["page_url" if c == "url" else c for c in keep]
    return explode_links(with_links(docs, **options), keep=keep)


# Parts of a listed domain's links in the joins below: no host is one task.
_SALTS = 32


def restrict_domains(links: DataFrame, domains: DataFrame, *, keep: bool = True) -> DataFrame:
    """Keep (or drop) links whose host is in or below one of ``domains.domain``.

    For lists too long to write into the plan.  A host meets the domains of ``n`` labels by
    its own last ``n`` labels, one equijoin for every number of labels that the list has, so
    a link is one row throughout and hosts never meet in a suffix that is too short to be
    listed.  Each domain stands in ``_SALTS`` parts, so a host with very many links is spread.
    The links are read once and may be a stream; the list is a table, null and empty domains in it count for nothing.
    """
    listed = domains.select(F.lower("domain").alias("_domain")).where("_domain <> ''").distinct().withColumn(
        "_labels", F.size(F.split("_domain", r"\.")))
    lengths = sorted(row["_labels"] for row in listed.select("_labels").distinct().collect())       # names of hosts have 127 labels at most
    work = links.withColumns({
        "_names": F.split(urls.netloc(F.col("url")), r"\."),
        "_part": F.pmod(F.xxhash64("url", *links.columns[:1]), F.lit(_SALTS)).cast("int"), "_found": F.lit(False)})
    for n in lengths:
        parted = listed.where(F.col("_labels") == n).select(
            F.col("_domain"), F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("_listed_part"))
        tail = F.when(F.size("_names") >= n, F.array_join(F.slice("_names", -n, n), "."))
        work = work.withColumn("_tail", tail).join(
            parted, (F.col("_tail") == F.col("_domain")) & (F.col("_part") == F.col("_listed_part")), "left")
        work = work.withColumn("_found", F.col("_found") | F.col("_domain").isNotNull()).drop("_tail", "_domain", "_listed_part")
    return work.where(F.col("_found") if keep else ~F.col("_found")).select(*links.columns)
