"""Text, URL and hash functions: columns in, columns out, all in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What the feeds' own text functions call white space: Unicode space and the controls 28 to 31.
_SPACE = r"[\s\x1c-\x1f]"
#: Schemes whose last path segment may carry ;params (fixed values).
_PARAM_SCHEMES = ("", "ftp", "hdl", "prospero", "http", "https", "shttp", "rtsp", "rtsps", "sip", "sips", "mms", "sftp", "tel")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U)^{_SPACE}+|{_SPACE}+$", "")


def collapse_space(c: Column) -> Column:
    return F.regexp_replace(strip(c), rf"(?U){_SPACE}+", " ")


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor empty; empty if none is."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def filled_or_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def default_text(c: Column, default: str) -> Column:
    return F.coalesce(filled_or_null(c), F.lit(default))


def normalize_link(link: Column) -> Column:
    """scheme://host/path in lower-case scheme and host, without query, fragment, ;params of the
    last segment and trailing slashes; an empty path is /.  Null and empty give empty; parts that
    are missing stay empty, so a relative link begins with ://."""
    url = F.regexp_replace(strip(link), r"^[\x00-\x20]+|[\t\r\n]", "")
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))
    rest = F.when(scheme == "", url).otherwise(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.\-]*:", ""))
    host = F.lower(F.regexp_extract(rest, r"^//([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"(?s)^(?://[^/?#]*)?([^?#]*)", 1)
    path = F.when(scheme.isin(*_PARAM_SCHEMES), F.regexp_replace(path, r";[^/]*$", "")).otherwise(path)
    path = first_filled(F.regexp_replace(path, r"/+$", ""), F.lit("/"))
    return F.when(F.coalesce(link, F.lit("")) == "", F.lit("")).otherwise(F.concat(scheme, F.lit("://"), host, path))


def https_variant(link: Column) -> Column:
    return F.regexp_replace(link, r"^http://", "https://")


def feed_link(link: Column) -> Column:
    """Cut at ? and #, with exactly one slash at the end; empty stays empty."""
    cut = F.regexp_replace(F.regexp_replace(strip(F.coalesce(link, F.lit(""))), r"(?s)[?#].*$", ""), r"/+$", "")
    bare = F.regexp_replace(strip(F.coalesce(link, F.lit(""))), r"(?s)[?#].*$", "")
    return F.when(bare == "", F.lit("")).otherwise(F.concat(cut, F.lit("/")))


def _number(c: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(c, pattern, group).try_cast("long")


def story_id(link: Column) -> Column:
    """n of .../k-n, else of ...-n at the end, else 0; trailing slashes don't count."""
    url = F.regexp_replace(F.coalesce(link, F.lit("")), r"/+$", "")
    return F.coalesce(_number(url, r"/(\d+)-(\d+)$", 2), _number(url, r"-(\d+)$", 1), F.lit(0).cast("long"))


def article_id(link: Column) -> Column:
    return F.coalesce(_number(F.coalesce(link, F.lit("")), r"/article/(\d+)", 1), F.lit(0).cast("long"))


def post_id(link: Column) -> Column:
    return F.coalesce(_number(F.coalesce(link, F.lit("")), r"-(\d+)/?$", 1), F.lit(0).cast("long"))


def dated_path_slug(link: Column) -> Column:
    """The segment after /20yy/m/d/, in lower case; null without one."""
    return F.nullif(F.lower(F.regexp_extract(link, r"(?i)/20\d{2}/\d{1,2}/\d{1,2}/([^/]+)/", 1)), F.lit(""))


def dated_path_section(link: Column, sections: Sequence[str], rename: dict[str, str] | None = None) -> Column:
    """The slug, renamed where a section goes by another name; null if it is no known section."""
    slug = dated_path_slug(link)
    for old, new in (rename or {"featured": "features"}).items():
        slug = F.when(slug == old, F.lit(new)).otherwise(slug)
    known = [*sections, *(rename or {"featured": "features"}).values()]
    return F.when(slug.isin(*known), slug)


def needle_section(link: Column, hints: Sequence[tuple[str, str]]) -> Column:
    """The section of the first needle that the link contains, in the order given."""
    out = F.lit(None).cast("string")
    for needle, section in reversed(hints):
        out = F.when(F.contains(link, F.lit(needle)), F.lit(section)).otherwise(out)
    return out


def title_key(title: Column, suffix: str) -> Column:
    """The title in lower case, without the outlet's name after a dash or bar at its end."""
    quoted = "".join("\\" + c if not c.isalnum() and c != " " else c for c in suffix)
    return F.lower(F.regexp_replace(strip(F.coalesce(title, F.lit(""))), rf"(?iU)\s*[-|]\s*{quoted}\s*$", ""))


def composite_key(link: Column, title: Column, domain: str, suffix: str, norm: Column | None = None) -> Column:
    """url:<link> for links of the domain, else title:<key>, else url:<link>.  norm: the normalised link, if it is at hand."""
    by_url, key = F.concat(F.lit("url:"), normalize_link(link) if norm is None else norm), title_key(title, suffix)
    return F.when(F.contains(F.coalesce(link, F.lit("")), F.lit(domain)), by_url).when(key != "", F.concat(F.lit("title:"), key)).otherwise(by_url)


def redirect_target(link: Column, domain: str) -> Column:
    """The outlet's URL inside the base64url payload of /articles/<payload>; else the link."""
    payload = F.regexp_extract(link, r"/articles/([^?&#]+)", 1)
    plain = F.translate(payload, "-_", "+/")
    padded = F.rpad(plain, (F.ceil(F.length(plain) / 4) * 4).cast("int"), F.lit("="))
    body = F.decode(F.try_to_binary(padded, F.lit("base64")), "ISO-8859-1")
    host = domain.replace(".", r"\.")
    found = F.regexp_replace(F.regexp_extract(body, rf"(https?://(?:www\.)?{host}/[^\x00-\x20\"'<>]+)", 1), r"\.+$", "")
    return F.when((payload != "") & (F.coalesce(found, F.lit("")) != ""), found).otherwise(link)


def absolute_link(href: Column, base: str) -> Column:
    scheme = base.split("://", 1)[0]
    return F.when(F.startswith(href, F.lit("//")), F.concat(F.lit(f"{scheme}:"), href)).when(
        F.startswith(href, F.lit("/")), F.concat(F.lit(base.rstrip("/")), href)
    ).otherwise(href)


def joined_link(href: Column, page: str) -> Column:
    """href as a page of the address `page` means it: with a scheme, without one (//host), from the root, or
    relative to the page's folder, ./ and ../ resolved; empty is the page itself."""
    scheme, rest = page.split("://", 1)
    host, _, path = rest.partition("/")
    folder = "/" + path.rpartition("/")[0].strip("/")
    root = f"{scheme}://{host}"
    tail = F.regexp_extract(href, r"(?s)([?#].*)$", 1)
    steps = F.split(F.concat(F.lit(folder.rstrip("/") + "/"), F.regexp_replace(href, r"(?s)[?#].*$", "")), "/")
    walked = F.aggregate(F.slice(steps, F.lit(2), F.size(steps)), F.array().cast("array<string>"), lambda kept, s: F.when(
        s == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))).when(s == ".", kept).otherwise(F.concat(kept, F.array(s))))
    slash = F.when(F.rlike(href, F.lit(r"(^|/)\.\.?/?$")) & ~F.endswith(href, F.lit("/")) & (F.size(walked) > 0), "/").otherwise("")
    relative = F.concat(F.lit(root + "/"), F.array_join(walked, "/"), slash, tail)
    query = F.concat(F.lit(f"{root}/{path.partition('?')[0].partition('#')[0]}"), href)
    return (
        F.when(href == "", F.lit(page)).when(F.rlike(href, F.lit(r"^[A-Za-z][A-Za-z0-9+.\-]*:")), href).when(F.startswith(href, F.lit("//")), F.concat(F.lit(f"{scheme}:"), href))
        .when(F.startswith(href, F.lit("/")), F.concat(F.lit(root), href)).when(F.rlike(href, F.lit("^[?#]")), query).otherwise(relative)
    )


def content_hash(title: Column, summary: Column) -> Column:
    return F.sha2(F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(summary, F.lit(""))), 256)


def ascii_only(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\x00-\x7F]", "")


def truncate(c: Column, limit: int, mark: str = "") -> Column:
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit(mark))).otherwise(c)


def batch_number(row_number: Column, size: int = 25) -> Column:
    """1 for the first `size` rows (numbered from 1), 2 for the next."""
    return F.floor((row_number - 1) / size) + 1


def backoff_seconds(attempt: Column) -> Column:
    return F.pow(F.lit(2), attempt).cast("long")


#: Shapes of article addresses (fixed values): dated path, /kind/id, and category-number.
ARTICLE_SHAPES = {"dated": r"(?i)/20\d{2}/\d{1,2}/\d{1,2}/", "of_year": r"/20\d{2}/", "numbered": r"/(?:article|news|story)/\d+", "prefixed": r"/108-\d+"}


def is_article_link(link: Column, shape: str, exclude: Sequence[str] = ("epaper.", "archives.")) -> Column:
    """The link has the shape of an article's and none of the excluded parts."""
    out = F.rlike(link, F.lit(ARTICLE_SHAPES[shape]))
    for part in exclude:
        out = out & ~F.contains(link, F.lit(part))
    return F.coalesce(out, F.lit(False))


#: Parts that mark list and service pages (fixed values).
NO_ARTICLE = ("category", "author", "about", "contact", "archives", "classifieds", "/page/", "/tag/")


def looks_like_article(link: Column, slashes: int = 2, longer_than: int = 10, exclude: Sequence[str] = NO_ARTICLE) -> Column:
    """By its path alone: enough slashes, long enough, and none of the excluded parts in the link."""
    path = F.regexp_extract(link, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)?([^?#]*)", 1)
    out = (F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit(""))) >= slashes) & (F.length(path) > longer_than) & ~F.startswith(link, F.lit("#"))
    for part in exclude:
        out = out & ~F.contains(link, F.lit(part))
    return F.coalesce(out, F.lit(False))


def without_slash(link: Column) -> Column:
    """A key that doesn't tell a trailing slash."""
    return F.regexp_replace(link, r"/+$", "")
