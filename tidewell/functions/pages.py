"""Text and links of HTML pages, as column expressions over whole pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ANCHOR = r"(?is)<a\s[^>]*?href\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))[^>]*>(.*?)</a>"
#: Elements whose text is dropped; after the links were read, menus go too.
DROPPED = ("script", "style", "noscript", "template", "svg", "nav")
BLOCK = r"(?i)</?(?:p|div|section|article|main|aside|header|footer|h[1-6]|ul|ol|li|dl|dt|dd|table|tr|form|blockquote|pre|hr|br)(?:\s[^>]*)?/?>"
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&"))
# Alternative texts that say nothing.
GENERIC_ALT = ("logo", "image", "img", "photo", "picture", "icon", "banner", "foto", "bild")


def plain(text: Column) -> Column:
    """Common references decoded, & last."""
    for name, char in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def one_line(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, r"[ \t\r\n\f]+", " "))


def absolute(href: Column, page: Column) -> Column:
    """The address that a reference on a page means: absolute ones as they are, others from the page's scheme, host or folder."""
    scheme = F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    root = F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_replace(page, r"[?#].*$", "")
    folder = F.when(path == root, F.concat(root, F.lit("/"))).otherwise(F.regexp_replace(path, r"[^/]*$", ""))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href.startswith("?"), F.concat(path, href))
        .otherwise(F.concat(folder, F.regexp_replace(href, r"^\./", "")))
    )


def links(html: Column, page: Column, label_chars: int = 90) -> Column:
    """Array of label and url of a page's anchors, the first of each url; fragments, scripts, mail and telephone links are none."""
    part = lambda a, k: F.regexp_extract(a, ANCHOR, k)
    href = lambda a: F.btrim(plain(F.concat(part(a, 1), part(a, 2), part(a, 3))))
    label = lambda a: F.substring(one_line(plain(F.regexp_replace(part(a, 4), r"(?s)<[^>]*>", " "))), 1, label_chars)
    found = F.transform(F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(0)), lambda a: F.struct(label(a).alias("label"), href(a).alias("href")))
    good = F.filter(found, lambda x: (x["href"] != "") & ~x["href"].rlike(r"(?i)^(?:#|javascript:|mailto:|tel:)"))
    named = F.transform(good, lambda x, i: F.struct(x["label"].alias("label"), absolute(x["href"], page).alias("url"), i.alias("i")))
    # The first of each url without comparing all pairs: sorted by url and place, each beside the one before.
    by_url = F.array_sort(F.transform(named, lambda x: F.struct(x["url"].alias("url"), x["i"].alias("i"), x["label"].alias("label"))))
    firsts = F.transform(F.array(by_url), lambda s: F.filter(F.transform(s, lambda x, k: F.when((k == 0) | (F.get(s, k - 1)["url"] != x["url"]), x)), lambda x: x.isNotNull()))[0]
    ordered = F.array_sort(F.transform(firsts, lambda x: F.struct(x["i"].alias("i"), x["label"].alias("label"), x["url"].alias("url"))))
    return F.transform(ordered, lambda x: F.struct(x["label"].alias("label"), x["url"].alias("url")))


def page_text(html: Column) -> Column:
    """The lines of a page's text: mail and telephone links written out, telling pictures in brackets, cells parted by bars, menus and scripts dropped."""
    x = F.regexp_replace(html, "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]", " ")
    x = F.regexp_replace(x, r"(?s)<!--.*?-->", " ")
    for name in DROPPED:
        x = F.regexp_replace(x, rf"(?is)<{name}(?:\s[^>]*)?>.*?</{name}\s*>", " ")
    x = F.regexp_replace(x, r"(?is)<a\s[^>]*?href\s*=\s*[\"']?mailto:([^\"'?>\s]*)[^>]*>(.*?)</a>", "$2 <mailto>$1</mailto>")
    x = F.regexp_replace(x, r"(?is)<a\s[^>]*?href\s*=\s*[\"']?tel:([^\"'?>\s]*)[^>]*>(.*?)</a>", "$2 <mailto>tel $1</mailto>")
    x = F.regexp_replace(x, r"(?is)<img\s[^>]*?alt\s*=\s*\"([^\">]{2,})\"[^>]*>", "[$1]")
    x = F.regexp_replace(x, rf"(?i)\[(?:{'|'.join(GENERIC_ALT)})\]", "")
    x = F.regexp_replace(x, r"(?i)</t[dh]\s*>", " | ")
    x = F.regexp_replace(x, r"[ \t\r\n\f]+", " ")
    x = F.regexp_replace(x, BLOCK, "\n")
    x = F.replace(F.replace(x, F.lit("<mailto>"), F.lit("\x01")), F.lit("</mailto>"), F.lit("\x02"))
    x = F.regexp_replace(x, r"<[^>]*>", "")
    x = F.replace(F.replace(plain(x), F.lit("\x01"), F.lit("<")), F.lit("\x02"), F.lit(">"))
    lines = F.filter(F.transform(F.split(x, "\n"), lambda s: F.btrim(F.regexp_replace(s, " +", " "))), lambda s: s != "")
    return F.array_join(lines, "\n")
