"""HTML extraction by shallow text features.

A page becomes a flat list of text blocks (text between block-level tags) with word
counts and link densities of each block and its neighbours (Kohlschuetter et al.
2010) and its place: inside an element for page furniture (an article or main that
opens inside ends that, but in comments, adverts and hidden parts), inside the article. A
decision tree, trained by Spark ML on the small labelled table below, tells article
text from the rest. Pages are independent rows, so there is no shuffle; a page is
read once, in time linear in its length.

A word of a class, id or role names furniture only if all of its compound does ("ad-slot",
"comments area"). Beside any other word ("related-work"), and in the id of a heading or
paragraph, it is a hint: the block's words, links and neighbours decide.

Defined cases: null or empty html, and a page without article text, give the empty
string; a very long page is read whole, in its task; ties in the tree go to the smaller label;
repeated rows are read alike; an empty table gives an empty table; further input columns are
ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession

from .common import longs, map_batches, record, texts

# Elements that the HTML standard lays out as blocks.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu "
    "nav noscript object ol optgroup option p pre search section select summary svg table tbody td template tfoot th "
    "thead tr ul".split())
# Void elements, which have no end tag.
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements whose content is no markup; none of it is page text.
RAW_TAGS = frozenset("script style title textarea xmp noembed noframes".split())
#: Elements that hold furniture, whatever their attributes say.
FURNITURE_TAGS = frozenset("nav footer aside form button select menu dialog template noscript iframe svg object head".split())
#: Words of class, id and role that name furniture.
FURNITURE_WORDS = frozenset(
    "ad ads adsbygoogle advert adverts advertisement advertising alert banner breadcrumb breadcrumbs byline comment "
    "comments consent contentinfo cookie cookies copyright disqus dropdown footer gdpr login masthead menu modal nav "
    "navbar navigation newsletter notice notification outbrain overlay pager pagination paywall popup promo promoted "
    "promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor "
    "sponsored subscribe subscription taboola toc toolbar widget widgets".split())
ARTICLE_TAGS = frozenset(("article", "main"))
#: Of them, words of reader comments: they mark an article as furniture, too.
COMMENT_WORDS = frozenset("comment comments disqus replies reply respond".split())
#: Words that name no frame of a page: an article inside such an element is furniture.
FIRM_WORDS = COMMENT_WORDS | frozenset(
    "ad ads adsbygoogle advert adverts advertisement advertising cookie cookies consent gdpr outbrain paywall promo "
    "promoted promotion recommended related sponsor sponsored taboola".split())
#: Words that name furniture even beside a layout word ("page-footer").
PLAIN_WORDS = FIRM_WORDS | frozenset(
    "breadcrumb breadcrumbs byline contentinfo copyright footer masthead menu nav navbar navigation pager pagination".split())
#: Words of a compound that name no content: with these alone beside it, a furniture word holds.
STRUCTURE_WORDS = frozenset(
    "area article bar block body bottom box btn button caption cell code col column container entry foot form frame global "
    "group head header holder id inner item items js left link links list main message module outer panel post primary right "
    "row section secondary site slot small story text title top unit wrap wrapper zone".split())
#: Furniture words after these in a compound, or before those, tell what a page has or lacks.
STATE_BEFORE = frozenset("has no with without not hide show enable disable".split())
STATE_AFTER = frozenset("open closed enabled disabled on off".split())
#: An element so named frames the page; a furniture word beside it is only a hint.
LAYOUT_WORDS = frozenset("layout content page template".split())
#: How surely an element is furniture. An article or main that opens inside ends all but the last.
NONE, HINT, FURNITURE, FIRM = range(4)
#: The feature of the tree for each.
FURNITURE_FEATURE = (0.0, 0.5, 1.0, 1.0)
#: Elements of furniture that may enclose a whole page.
FRAME_TAGS = frozenset(("form", "object"))
# Elements whose start ends an open one, as the HTML standard says.
ENDED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"),
            "tr": ("td", "th", "tr"), "option": ("option",)}
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

_MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+[\"']?[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|\Z)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)

FEATURES = ("words", "link_density", "prev_words", "prev_link_density", "next_words", "next_link_density",
            "furniture", "place", "heading")

#: Labelled blocks: the features as above, then 1 for article text. ``place`` is 1
#: inside the page's article, -1 outside of it, 0 on a page that marks none.
LABELLED = (
    # paragraphs of a marked article, of any length
    (84, 0.0, 51, 0.0, 97, 0.0, 0, 1, 0, 1), (41, 0.0, 8, 0.0, 66, 0.0, 0, 1, 0, 1), (12, 0.0, 70, 0.0, 2, 0.0, 0, 1, 0, 1),
    (3, 0.0, 45, 0.0, 80, 0.0, 0, 1, 0, 1), (1, 0.0, 1, 0.0, 60, 0.0, 0, 1, 0, 1), (1, 0.0, 33, 0.0, 9, 0.4, 0, 1, 0, 1),
    (120, 0.08, 40, 0.0, 77, 0.0, 0, 1, 0, 1), (55, 0.2, 60, 0.1, 48, 0.0, 0, 1, 0, 1), (26, 0.4, 90, 0.0, 31, 0.0, 0, 1, 0, 1),
    (7, 0.0, 6, 1.0, 60, 0.0, 0, 1, 0, 1), (9, 0.0, 11, 0.0, 7, 0.0, 0, 1, 0, 1), (2, 0.0, 14, 0.0, 0, 0.0, 0, 1, 0, 1),
    (300, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1), (5, 0.0, 0, 0.0, 5, 0.0, 0, 1, 0, 1), (15, 0.33, 44, 0.0, 52, 0.0, 0, 1, 0, 1),
    (4, 0.0, 4, 0.0, 25, 0.0, 0, 1, 0, 1), (6, 0.0, 85, 0.0, 11, 0.0, 0, 1, 0, 1), (4, 0.0, 58, 0.0, 7, 1.0, 0, 1, 0, 1),
    (8, 0.0, 3, 0.0, 4, 0.0, 0, 1, 0, 1), (30, 0.0, 5, 0.0, 6, 0.0, 0, 1, 0, 1), (18, 0.0, 5, 1.0, 4, 1.0, 0, 1, 0, 1),
    (2, 0.0, 2, 0.0, 2, 0.0, 0, 1, 0, 1), (5, 0.0, 18, 0.0, 22, 0.0, 0, 1, 0, 1), (3, 0.0, 28, 0.1, 1, 1.0, 0, 1, 0, 1),
    (64, 0.0, 70, 0.0, 14, 0.0, 0, 1, 0, 1), (47, 0.5, 62, 0.0, 70, 0.1, 0, 1, 0, 1), (4, 0.25, 9, 0.0, 8, 0.0, 0, 1, 0, 1),
    # headings of an article
    (9, 0.0, 10, 0.0, 9, 0.0, 0, 1, 1, 1), (6, 0.0, 40, 0.0, 55, 0.0, 0, 1, 1, 1), (2, 0.0, 70, 0.0, 12, 0.0, 0, 1, 1, 1),
    (11, 0.0, 1, 1.0, 64, 0.0, 0, 1, 1, 1), (4, 0.0, 9, 0.0, 4, 0.0, 0, 1, 1, 1), (3, 0.0, 11, 0.0, 3, 0.0, 0, 1, 1, 1),
    # whatever stands beside it: link lists and short lines before and after
    (45, 0.0, 60, 0.0, 1, 1.0, 0, 1, 0, 1), (12, 0.0, 33, 0.0, 2, 1.0, 0, 1, 0, 1), (70, 0.0, 44, 0.0, 3, 1.0, 0, 1, 0, 1),
    (1, 0.0, 20, 0.0, 1, 1.0, 0, 1, 0, 1), (8, 0.0, 7, 0.0, 5, 1.0, 0, 1, 0, 1), (3, 0.0, 2, 1.0, 2, 1.0, 0, 1, 0, 1),
    (22, 0.0, 1, 1.0, 1, 1.0, 0, 1, 0, 1), (60, 0.1, 3, 1.0, 1, 1.0, 0, 1, 0, 1), (2, 0.0, 3, 0.0, 1, 1.0, 0, 1, 0, 1),
    (5, 0.0, 1, 1.0, 3, 0.0, 0, 1, 0, 1), (11, 0.0, 2, 0.0, 1, 0.0, 0, 1, 0, 1), (38, 0.0, 10, 0.5, 4, 0.6, 0, 1, 0, 1),
    (16, 0.0, 80, 0.0, 1, 0.5, 0, 1, 0, 1), (4, 0.0, 4, 0.0, 4, 0.8, 0, 1, 0, 1), (95, 0.0, 2, 0.0, 6, 1.0, 0, 1, 0, 1),
    (7, 0.0, 62, 0.0, 2, 1.0, 0, 1, 1, 1), (3, 0.0, 2, 1.0, 1, 1.0, 0, 1, 1, 1), (8, 0.0, 1, 1.0, 3, 0.0, 0, 1, 1, 1),
    (13, 0.0, 0, 0.0, 1, 1.0, 0, 1, 0, 1), (26, 0.0, 5, 1.0, 0, 0.0, 0, 1, 0, 1), (6, 0.0, 3, 0.0, 2, 1.0, 0, 1, 0, 1),
    (4, 0.0, 1, 0.0, 60, 0.0, 0, 1, 0, 1), (5, 0.0, 2, 0.0, 20, 0.0, 0, 1, 0, 1), (2, 0.0, 2, 0.0, 9, 0.0, 0, 1, 0, 1),
    (3, 0.0, 1, 1.0, 30, 0.0, 0, 1, 0, 1), (2, 0.0, 0, 0.0, 14, 0.0, 0, 1, 0, 1), (4, 0.0, 2, 1.0, 71, 0.1, 0, 1, 0, 1),
    (5, 0.0, 1, 0.0, 41, 0.0, 0, 1, 0, 1), (3, 0.0, 2, 0.5, 8, 0.0, 0, 1, 0, 1),
    # lists of links inside an article
    (6, 1.0, 50, 0.0, 7, 1.0, 0, 1, 0, 0), (4, 1.0, 4, 1.0, 5, 1.0, 0, 1, 0, 0), (12, 0.92, 30, 0.0, 9, 1.0, 0, 1, 0, 0),
    (2, 1.0, 61, 0.0, 0, 0.0, 0, 1, 0, 0), (8, 1.0, 8, 1.0, 40, 0.0, 0, 1, 0, 0),
    # furniture inside an article: adverts, comments, share bars, forms
    (14, 0.0, 60, 0.0, 75, 0.0, 1, 1, 0, 0), (70, 0.0, 33, 0.0, 58, 0.0, 1, 1, 0, 0), (3, 0.7, 90, 0.0, 2, 0.0, 1, 1, 0, 0),
    (45, 0.0, 3, 0.0, 40, 0.0, 1, 1, 0, 0), (2, 0.0, 50, 0.0, 44, 0.0, 1, 1, 1, 0), (22, 0.1, 18, 0.0, 30, 0.0, 1, 1, 0, 0),
    # furniture elsewhere: menus, notices, footers, sidebars
    (1, 1.0, 1, 1.0, 1, 1.0, 1, -1, 0, 0), (10, 0.0, 1, 1.0, 9, 0.0, 1, -1, 0, 0), (13, 0.0, 50, 0.0, 0, 0.0, 1, -1, 0, 0),
    (60, 0.05, 8, 0.0, 41, 0.0, 1, -1, 0, 0), (5, 0.0, 4, 0.0, 30, 0.0, 1, -1, 1, 0), (2, 1.0, 2, 1.0, 2, 1.0, 1, 0, 0, 0),
    (48, 0.0, 40, 0.0, 37, 0.0, 1, 0, 0, 0), (4, 0.0, 30, 0.0, 0, 0.0, 1, 0, 0, 0), (18, 0.2, 44, 0.0, 21, 0.0, 1, 0, 0, 0),
    (6, 0.0, 55, 0.0, 62, 0.0, 1, 0, 1, 0),
    (40, 0.0, 70, 0.0, 2, 1.0, 1, 1, 0, 0), (12, 0.0, 44, 0.0, 60, 0.0, 1, 1, 0, 0), (85, 0.0, 90, 0.0, 77, 0.0, 1, 0, 0, 0),
    # a hint of furniture (0.5: the words of a page's frame): long blocks are text, short ones or links are not
    (84, 0.0, 51, 0.0, 97, 0.0, 0.5, 1, 0, 1), (45, 0.0, 3, 0.0, 40, 0.0, 0.5, 1, 0, 1), (23, 0.1, 30, 0.0, 18, 0.0, 0.5, 1, 0, 1),
    (3, 0.0, 40, 0.0, 4, 0.0, 0.5, 1, 0, 0), (5, 1.0, 4, 1.0, 50, 0.0, 0.5, 1, 0, 0),
    (70, 0.0, 40, 0.0, 66, 0.0, 0.5, 0, 0, 1), (24, 0.05, 8, 0.0, 24, 0.0, 0.5, 0, 0, 1), (110, 0.02, 0, 0.0, 0, 0.0, 0.5, 0, 0, 1),
    (2, 0.0, 62, 0.0, 39, 0.0, 0.5, 0, 0, 0), (4, 0.0, 30, 0.0, 0, 0.0, 0.5, 0, 0, 0), (30, 0.9, 6, 1.0, 28, 0.9, 0.5, 0, 0, 0),
    (60, 0.0, 40, 0.0, 50, 0.0, 0.5, -1, 0, 0), (3, 1.0, 2, 1.0, 3, 1.0, 0.5, -1, 0, 0),
    (2, 0.0, 60, 0.0, 70, 0.0, 0.5, 1, 1, 1), (3, 0.0, 3, 0.0, 45, 0.0, 0.5, 1, 1, 1), (5, 0.0, 44, 0.0, 30, 0.0, 0.5, 1, 1, 1),
    (6, 0.0, 50, 0.0, 60, 0.0, 0.5, 1, 0, 1), (12, 0.0, 28, 0.0, 41, 0.0, 0.5, 1, 0, 1), (8, 0.0, 2, 1.0, 3, 1.0, 0.5, 1, 0, 0),
    (2, 0.0, 62, 0.0, 3, 1.0, 0.5, 1, 1, 0), (3, 0.0, 40, 0.0, 0, 0.0, 0.5, 1, 0, 0), (9, 0.1, 4, 1.0, 6, 0.9, 0.5, 1, 0, 0),
    (4, 0.0, 3, 0.0, 38, 0.0, 0.5, 0, 1, 1), (6, 0.0, 48, 0.0, 52, 0.0, 0.5, 0, 0, 1), (7, 0.0, 2, 1.0, 2, 1.0, 0.5, 0, 0, 0),
    # unmarked blocks beside a marked article
    (6, 0.0, 1, 1.0, 12, 0.0, 0, -1, 0, 0), (35, 0.0, 40, 0.0, 8, 0.0, 0, -1, 0, 0), (3, 1.0, 2, 1.0, 3, 1.0, 0, -1, 0, 0),
    (90, 0.0, 60, 0.0, 0, 0.0, 0, -1, 0, 0), (4, 0.0, 70, 0.0, 5, 0.0, 0, -1, 1, 0), (22, 0.0, 80, 0.0, 3, 0.5, 0, -1, 0, 0),
    # pages that mark no article: long blocks of few links, and what stands among them
    (60, 0.0, 45, 0.0, 72, 0.0, 0, 0, 0, 1), (38, 0.1, 12, 0.0, 50, 0.0, 0, 0, 0, 1), (25, 0.0, 8, 0.0, 40, 0.0, 0, 0, 0, 1),
    (110, 0.02, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (18, 0.0, 30, 0.0, 26, 0.0, 0, 0, 0, 1), (6, 0.0, 48, 0.0, 55, 0.0, 0, 0, 0, 1),
    (2, 0.0, 62, 0.0, 39, 0.0, 0, 0, 0, 1), (44, 0.25, 51, 0.0, 30, 0.1, 0, 0, 0, 1), (19, 0.0, 61, 0.0, 3, 0.8, 0, 0, 0, 1),
    # their headings before text
    (8, 0.0, 3, 1.0, 58, 0.0, 0, 0, 1, 1), (5, 0.0, 36, 0.0, 47, 0.0, 0, 0, 1, 1), (7, 0.0, 2, 0.0, 33, 0.0, 0, 0, 1, 1),
    # short and middling blocks: among text they are text, beside links they are not
    (1, 0.0, 40, 0.0, 50, 0.0, 0, 0, 0, 1), (3, 0.0, 70, 0.0, 25, 0.0, 0, 0, 0, 1), (8, 0.0, 22, 0.05, 61, 0.0, 0, 0, 0, 1),
    (12, 0.0, 15, 0.0, 80, 0.1, 0, 0, 0, 1), (5, 0.0, 55, 0.1, 18, 0.0, 0, 0, 0, 1), (10, 0.1, 33, 0.0, 47, 0.0, 0, 0, 0, 1),
    (14, 0.2, 60, 0.0, 44, 0.0, 0, 0, 0, 1), (4, 0.0, 31, 0.0, 27, 0.0, 0, 0, 0, 1), (2, 0.0, 26, 0.0, 90, 0.0, 0, 0, 0, 1),
    (16, 0.0, 71, 0.0, 1, 1.0, 0, 0, 0, 1), (20, 0.0, 50, 0.0, 3, 1.0, 0, 0, 0, 1), (28, 0.0, 64, 0.0, 1, 1.0, 0, 0, 0, 1),
    (17, 0.0, 2, 1.0, 48, 0.0, 0, 0, 0, 1), (24, 0.0, 1, 1.0, 66, 0.0, 0, 0, 0, 1), (40, 0.45, 60, 0.0, 55, 0.0, 0, 0, 0, 1),
    (33, 0.0, 3, 0.0, 71, 0.0, 0, 0, 0, 1), (29, 0.1, 4, 0.0, 38, 0.0, 0, 0, 0, 1),
    (1, 0.0, 3, 1.0, 4, 1.0, 0, 0, 0, 0), (3, 0.0, 1, 1.0, 50, 0.0, 0, 0, 0, 0), (4, 0.0, 6, 1.0, 2, 1.0, 0, 0, 0, 0),
    (8, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0), (12, 0.0, 1, 1.0, 2, 1.0, 0, 0, 0, 0), (5, 0.0, 2, 0.9, 60, 0.0, 0, 0, 0, 0),
    (10, 0.1, 4, 1.0, 5, 1.0, 0, 0, 0, 0), (14, 0.2, 3, 1.0, 2, 1.0, 0, 0, 0, 0), (7, 0.0, 60, 0.0, 1, 1.0, 0, 0, 0, 0),
    (3, 0.0, 44, 0.0, 2, 1.0, 0, 0, 0, 0), (11, 0.0, 71, 0.0, 1, 1.0, 0, 0, 0, 0), (16, 0.0, 1, 1.0, 2, 1.0, 0, 0, 0, 0),
    (18, 0.1, 3, 1.0, 4, 0.9, 0, 0, 0, 0), (22, 0.3, 2, 1.0, 1, 1.0, 0, 0, 0, 0), (40, 0.45, 3, 1.0, 2, 1.0, 0, 0, 0, 0),
    (9, 0.0, 3, 1.0, 0, 0.0, 0, 0, 0, 0), (6, 0.0, 2, 1.0, 5, 0.0, 0, 0, 0, 0), (3, 0.0, 0, 0.0, 1, 1.0, 0, 0, 0, 0),
    (12, 0.0, 4, 0.0, 0, 0.0, 0, 0, 0, 0), (5, 0.0, 3, 0.0, 2, 1.0, 0, 0, 0, 0),
    (11, 0.0, 80, 0.0, 4, 0.0, 0, 0, 0, 1), (9, 0.0, 60, 0.0, 2, 0.0, 0, 0, 0, 1), (5, 0.0, 71, 0.0, 3, 0.0, 0, 0, 0, 1),
    (30, 0.0, 50, 0.0, 2, 0.0, 0, 0, 0, 1), (26, 0.0, 4, 0.0, 3, 1.0, 0, 0, 0, 1), (6, 0.0, 40, 0.0, 3, 1.0, 0, 0, 0, 0),
    (9, 0.0, 52, 0.0, 4, 1.0, 0, 0, 0, 0), (4, 0.0, 28, 0.0, 2, 0.8, 0, 0, 0, 0), (12, 0.0, 66, 0.0, 8, 0.9, 0, 0, 0, 0),
    (40, 0.0, 85, 0.07, 2, 1.0, 0, 0, 0, 1), (60, 0.05, 90, 0.2, 3, 1.0, 0, 0, 0, 1),
    # their headings after link lists
    (5, 0.0, 2, 1.0, 55, 0.0, 0, 0, 1, 1), (4, 0.0, 1, 1.0, 60, 0.0, 0, 0, 1, 1), (5, 0.0, 1, 1.0, 27, 0.0, 0, 0, 1, 1),
    (6, 0.0, 2, 1.0, 87, 0.0, 0, 0, 1, 1), (3, 0.0, 4, 1.0, 34, 0.0, 0, 0, 1, 1),
    # headings of link lists
    (6, 0.0, 70, 0.0, 2, 1.0, 0, 0, 1, 0), (2, 0.0, 55, 0.0, 4, 1.0, 0, 0, 1, 0), (5, 0.0, 1, 1.0, 3, 1.0, 0, 0, 1, 0),
    (2, 0.0, 3, 1.0, 6, 1.0, 0, 0, 1, 0), (9, 0.0, 2, 1.0, 44, 0.0, 0, 0, 1, 1), (7, 0.0, 3, 0.0, 81, 0.0, 0, 0, 1, 1),
    (4, 0.0, 61, 0.0, 26, 0.0, 0, 0, 1, 1),
    # short blocks among short ones, and link lists
    (3, 0.0, 2, 1.0, 4, 0.0, 0, 0, 0, 0), (5, 0.0, 4, 0.0, 3, 1.0, 0, 0, 0, 0), (2, 1.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0),
    (9, 1.0, 8, 1.0, 50, 0.0, 0, 0, 0, 0), (30, 0.8, 6, 1.0, 28, 0.9, 0, 0, 0, 0), (4, 0.0, 45, 0.0, 2, 0.0, 0, 0, 0, 0),
    (7, 0.0, 0, 0.0, 3, 0.6, 0, 0, 0, 0), (3, 0.0, 5, 0.5, 2, 1.0, 0, 0, 1, 0), (6, 1.0, 70, 0.0, 7, 1.0, 0, 0, 0, 0),
)


def train_tree(spark: SparkSession, labelled=LABELLED):
    """Nested (feature number, threshold, left, right) tuples; leaves are 0 or 1."""
    rows = spark.createDataFrame([tuple(map(float, r)) for r in labelled], [*FEATURES, "label"]).coalesce(1)
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    model = DecisionTreeClassifier(maxDepth=10, maxBins=128, seed=1).fit(rows)

    def copied(node):
        if node.numDescendants() == 0:
            return int(node.prediction())
        split = node.split()
        return split.featureIndex(), split.threshold(), copied(node.leftChild()), copied(node.rightChild())

    return copied(model._java_obj.rootNode())


def classify(tree, features: tuple) -> int:
    while not isinstance(tree, int):
        number, threshold, left, right = tree
        tree = left if features[number] <= threshold else right
    return tree


def _named(value: str) -> set[str]:
    """Furniture words of a class, id or role, without those of states; marked with a
    star where they are only a hint."""
    found = set()
    tokens = [re.findall("[a-z]+", t) for t in re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower().split()]
    frame = any(len(t) == 1 and t[0] in LAYOUT_WORDS for t in tokens)
    for words in tokens:
        for i, word in enumerate(words):
            if word in STATE_BEFORE and i + 1 < len(words):
                break  # the rest of the compound is what the page has or lacks
            if word in FURNITURE_WORDS and not (i + 1 < len(words) and words[i + 1] in STATE_AFTER):
                hint = word not in PLAIN_WORDS and (frame or not LAYOUT_WORDS.isdisjoint(words[:i]))
                # beside a word of content, as in the ids that headings get, it says little
                hint |= any(len(w) > 1 and w not in FURNITURE_WORDS | STRUCTURE_WORDS | LAYOUT_WORDS | STATE_AFTER for w in words)
                found.add(word + "*" * hint)
    return found


def _furniture(tag: str, rest: str) -> int:
    """How surely the element itself is furniture."""
    if tag in FURNITURE_TAGS:
        return FURNITURE if tag in FRAME_TAGS else FIRM
    if not rest or tag in ("html", "body"):
        return NONE
    framed = tag in ARTICLE_TAGS
    if not framed and ("hidden" in rest or "none" in rest) and _HIDDEN.search(rest):
        return FIRM
    sure = NONE
    for m in _ATTRIBUTE.finditer(rest):
        named = _named(m[2] or m[3] or m[4] or "")
        if m[1].lower() == "id" and (tag == "p" or tag in HEADINGS):
            named = {w.rstrip("*") + "*" for w in named}  # made from their text, often
        if not named.isdisjoint(COMMENT_WORDS if framed else FIRM_WORDS):
            return FIRM
        if named and not framed:
            sure = max(sure, HINT if all(w.endswith("*") for w in named) else FURNITURE)
    return sure


def blocks(html: str) -> list[dict]:
    """The page's text blocks in order: text, words, link words, furniture, article, heading."""
    out: list[dict] = []
    open_tags: list[tuple[str, int, bool]] = []  # (tag, furniture, article) of block elements and marked inline ones
    n_open: Counter = Counter()  # of open_tags, so that an end tag without a start costs nothing
    parts: list[str] = []
    linked = 0  # words inside links
    in_link = heading = False

    def start_of(tag: str, furniture: int, article: bool) -> None:
        open_tags.append((tag, furniture, article))
        n_open[tag] += 1

    def end_open(*tags: str) -> None:
        while open_tags and open_tags[-1][0] in tags:
            n_open[open_tags.pop()[0]] -= 1

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            inside = open_tags[-1] if open_tags else ("", NONE, False)
            words = text.count(" ") + 1
            out.append({"text": text, "words": words, "links": min(words, linked), "furniture": inside[1],
                        "article": inside[2], "heading": heading})
        linked = 0

    at, n = 0, len(html)
    while at < n:
        m = _MARKUP.search(html, at)
        piece = html[at:m.start()] if m else html[at:]
        if piece:
            piece = unescape(piece)
            parts.append(piece)
            if in_link:
                linked += len(piece.split())
        if not m:
            break
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        rest = m["rest"]
        if tag in RAW_TAGS:
            if not m["end"]:
                stop = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(html, at)
                at = stop.start() if stop else n
            continue
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link = not m["end"]
        block = tag in BLOCK_TAGS
        if block:
            flush()
            in_link = False if m["end"] else in_link
            heading = tag in HEADINGS and not m["end"]
        if tag in VOID_TAGS or tag == "p":
            # a paragraph ends at the next block tag; its own class still counts
            if tag == "p":
                end_open("p")
                if not m["end"] and (own := _furniture(tag, rest)):
                    _, furniture, article = open_tags[-1] if open_tags else ("", NONE, False)
                    start_of(tag, max(furniture, own), article)
            continue
        if block:
            end_open("p")
            if not m["end"]:
                end_open(*ENDED_BY.get(tag, ()))
                _, furniture, article = open_tags[-1] if open_tags else ("", NONE, False)
                if tag in ARTICLE_TAGS and furniture < FIRM:
                    furniture = NONE
                furniture = max(furniture, _furniture(tag, rest), FURNITURE if tag == "header" and not article else NONE)
                if not rest.endswith("/") or tag not in ("svg", "object", "iframe"):
                    start_of(tag, furniture, article or tag in ARTICLE_TAGS)
            elif n_open[tag]:
                while True:
                    ended = open_tags.pop()[0]
                    n_open[ended] -= 1
                    if ended == tag:
                        break
    flush()
    return out


def article(html: str, tree) -> str:
    """The page's article text: blocks that the tree accepts, joined by newlines."""
    found = blocks(html)
    marked = any(b["article"] for b in found)
    density = [b["links"] / b["words"] for b in found]
    kept = []
    for i, b in enumerate(found):
        before = (found[i - 1]["words"], density[i - 1]) if i else (0, 0.0)
        after = (found[i + 1]["words"], density[i + 1]) if i + 1 < len(found) else (0, 0.0)
        place = 1 if b["article"] else -1 if marked else 0
        if classify(tree, (b["words"], density[i], *before, *after, FURNITURE_FEATURE[b["furniture"]], place, int(b["heading"]))):
            kept.append(b["text"])
    return "\n".join(kept)


def extract(pages: DataFrame, labelled=LABELLED) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    tree = train_tree(pages.sparkSession, labelled)
    kinds = dict(pages.dtypes)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = [article(h, tree) for h in texts(batch, "html")]
        return record(page_id=batch.column("page_id"), url=batch.column("url"), text=pa.array(got, pa.string()),
                      n_chars=longs([len(t) for t in got]))

    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return map_batches(pages.select("page_id", "url", "html"), run, schema)
