"""Column functions on OCR text: normalised keys, predicates, guards. All stay in whole-stage codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character sets that decide results.
#: Deleted from keys besides white space.
KEY_DROPS = "，。,.、·:：;；\"'“”‘’《》<>![]【】?？"
#: Deleted when a verified reading is compared (question marks count there).
VERIFY_DROPS = "，。,.、·:：;；\"'“”‘’《》<>![]【】"
#: Deleted when a reading is compared and quotes are the suspicion itself.
QUOTED_DROPS = "，。,.、·:：;；\"'<>![]【】"
#: Deleted in table-of-contents checks.
QC_DROPS = KEY_DROPS + "#*"
#: A block that ends with one of these ends a sentence, for joining text across pages.
SENTENCE_END = "。！？!?:：;；…””’」》》）)]"
#: The same question when an opening quote at the head of a page is suspected; the sets differ on purpose.
SENTENCE_END_BEFORE_QUOTE = "。！？!?”』」：:;；"
STRICT_PAIRS = ("《》", "（）", "「」", "‘’")
LOOSE_PAIR = "“”"
TRADITIONAL_IN_FLAGS = "證據適體學經國關問間這還進遠運過選遺鄉麗龜龍龔實臺曆歷"
TRADITIONAL_IN_READINGS = "學習時間問題國家會議東門車馬龍鳳複雜後裡麼書寫話語讀聽聲醫萬與長無為這來對關於經過開關現在點從還進運過道那說她他們"
RARE = "否登涉粱汾渭浚芮晁扈戛轼鹑骅羁囡殇烨骞虢澹踵隼蹙鲸嚼淼焱垚骉猋"
CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳"
SPECIAL_STARTS = ("#", "- ", "* ", "+ ", "[^", "!", "<", "|")
FULL_WIDTH = {",": "，", ":": "：", ";": "；", "!": "！", "?": "？"}
NUMBERED_CHAPTER = r"^\d{1,2}[.、]\s*\S{2,30}$"
ORDINAL_FAMILIES = {"其": "^其[一二三四五六七八九十]{1,2}$", "第": "^第[一二三四五六七八九十]{1,3}$"}
BIO_OPENING = r"^[一-龥]{2,4}\s*(（\d{4}[—–-]\d{0,4}）|[12]\d{3}年生|，原名)"
AUTHOR_NAME = "^[一-龥·]{2,4}$"
PAGE_NUMBER_TAIL = r"\s[0-9IilLoO]{1,4}$"
TOC_NUMBER_TAIL = r"\s*[-—–….·]*\s*\d{1,4}\s*$"
FRONT_MATTER_TYPES = ("封面", "版权页", "编者言", "目录", "插图页", "空白", "扉页", "前言", "序言", "跋")

#: The two ranges of Chinese characters in use; neither replaces the other.
CJK_TO_9FA5, CJK_TO_9FFF = r"[\x{4E00}-\x{9FA5}]", r"[\x{4E00}-\x{9FFF}]"


def char_class(chars: str) -> str:
    """The inside of a regex class for these characters, for Java, Python and RE2 alike."""
    return "".join("\\" + c if c in "[]\\^-&" else c for c in dict.fromkeys(chars))


def normalised(text: Column, drops: str = KEY_DROPS) -> Column:
    """Key of a text: white space (of Unicode) and ``drops`` deleted; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"(?U)[\\s{char_class(drops)}]", "")


def without_space(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", "")


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def is_blank(text: Column) -> Column:
    return F.coalesce(stripped(text), F.lit("")) == ""


def without_tags(html: Column) -> Column:
    return F.regexp_replace(html, "<[^>]+>", "")


def is_heading(line: Column) -> Column:
    return F.regexp_like(line, F.lit(r"(?U)\A\s*#"))


def heading_title(line: Column) -> Column:
    return stripped(F.regexp_replace(line, r"(?U)\A\s*#+\s*", ""))


def heading_level(line: Column) -> Column:
    return F.length(F.regexp_extract(line, r"(?U)\A\s*(#+)", 1))


def without_list_mark(line: Column, needs_space: bool = True) -> Column:
    return F.regexp_replace(line, rf"(?U)\A[-*+]\s{'+' if needs_space else '*'}", "")


def without_toc_number(entry: Column) -> Column:
    return stripped(F.regexp_replace(entry, "(?U)" + TOC_NUMBER_TAIL, ""))


def is_numbered_chapter(text: Column) -> Column:
    return F.regexp_like(without_space(text), F.lit("(?U)" + NUMBERED_CHAPTER))


def ordinal_family(text: Column) -> Column:
    """The family whose form the whole text has, without white space; null if none."""
    bare = without_space(text)
    return F.coalesce(*[F.when(F.regexp_like(bare, F.lit(form)), F.lit(family)) for family, form in ORDINAL_FAMILIES.items()])


def is_plain(line: Column) -> Column:
    """Body text: not empty, no heading, list item, note, image, tag, table row or circled number."""
    special = reduce(lambda a, b: a | b, [F.startswith(line, F.lit(s)) for s in SPECIAL_STARTS])
    return (F.length(line) > 0) & ~special & ~F.regexp_like(line, F.lit(f"^[{CIRCLED}]"))


def is_cjk(char: Column) -> Column:
    return F.regexp_like(char, F.lit(f"^{CJK_TO_9FFF}$"))


def last_char(text: Column) -> Column:
    return F.right(text, F.lit(1))


def joiner(before: Column, after: Column) -> Column:
    """Nothing between two Chinese characters, else a space."""
    return F.when(is_cjk(last_char(before)) & is_cjk(F.left(after, F.lit(1))), "").otherwise(" ")


def ends_sentence(text: Column, ends: str = SENTENCE_END) -> Column:
    last = last_char(text)
    return (F.length(last) > 0) & F.contains(F.lit(ends), last)


def count_char(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def count_in(text: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{char_class(chars)}]", ""))


def chars_in(text: Column, chars: str) -> Column:
    """The characters of ``text`` that are in ``chars``, in order, repeats kept."""
    return F.regexp_replace(text, f"[^{char_class(chars)}]", "")


def pair_imbalance(text: Column) -> Column:
    """Array of the pairs whose sides differ in number; the quotes only if nothing else does and both sides occur."""
    strict = F.array(*[F.when(count_char(text, p[0]) != count_char(text, p[1]), F.lit(p)) for p in STRICT_PAIRS])
    strict = F.filter(strict, lambda p: p.isNotNull())
    left, right = count_char(text, LOOSE_PAIR[0]), count_char(text, LOOSE_PAIR[1])
    loose = (left > 0) & (right > 0) & (left != right)
    return F.when(F.size(strict) > 0, strict).when(loose, F.array(F.lit(LOOSE_PAIR))).otherwise(F.array().cast("array<string>"))


def occurrences(text: Column, part: Column) -> Column:
    """Number of occurrences that don't overlap; an empty part occurs once more than there are characters."""
    return F.when(F.length(part) == 0, F.length(text) + 1).otherwise((F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.length(part)).cast("bigint")


def adds_traditional(old: Column, new: Column) -> Column:
    return count_in(new, TRADITIONAL_IN_READINGS) > count_in(old, TRADITIONAL_IN_READINGS)


def length_ratio(old: Column, new: Column) -> Column:
    return F.length(new) / F.greatest(F.length(old), F.lit(1))


def within_ratio(old: Column, new: Column) -> Column:
    return length_ratio(old, new).between(F.lit(0.8), F.lit(2.0))


def shrinks(old: Column, new: Column) -> Column:
    return F.length(new) < F.lit(0.8) * F.length(old)


def localised_punctuation(text: Column) -> Column:
    """Half-width , ; : ! ? between two Chinese characters become full-width."""
    for half, full in FULL_WIDTH.items():
        text = F.regexp_replace(text, f"(?<={CJK_TO_9FFF})[{half}](?={CJK_TO_9FFF})", full)
    return text


def without_superscript(text: Column) -> Column:
    r"""``$^{①}$`` becomes ``①``."""
    return F.regexp_replace(text, rf"\$?\^\{{([{CIRCLED}*])\}}\$?", "$1")


def without_star_escape(text: Column) -> Column:
    return F.regexp_replace(text, r"""(?<=[。！？!?”’"』」）)])\\\*""", "*")


def json_in_prose(text: Column) -> Column:
    """What stands from the first { to the last }, as a variant; null if that is no JSON object."""
    first = F.instr(text, "{")
    last = F.length(text) - F.instr(F.reverse(text), "}") + 1
    body = F.when((first > 0) & (F.instr(text, "}") > 0) & (last > first), text.substr(first, last - first + 1))
    return F.try_parse_json(body)


def expanded_box(box: Column, margin: float = 0.15) -> Column:
    """A box [x0, y0, x1, y1] grown by a share of its size on each side and clamped to the page."""
    x0, y0, x1, y1 = (box[i] for i in range(4))
    dx, dy = (x1 - x0) * margin, (y1 - y0) * margin
    zero, one = F.lit(0.0), F.lit(1.0)
    return F.array(F.greatest(zero, x0 - dx), F.greatest(zero, y0 - dy), F.least(one, x1 + dx), F.least(one, y1 + dy))


def box_on_page(box: Column, width: Column, height: Column) -> Column:
    """A box in shares of the page, scaled to a page of that size."""
    return F.array(box[0] * width, box[1] * height, box[2] * width, box[3] * height)


def confidence(n: Column, start: float, step: float, most: float) -> Column:
    return F.least(F.lit(most), F.lit(start) + F.lit(step) * n)
