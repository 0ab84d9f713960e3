"""Names, registration numbers, labels and page text as Column expressions (all inside JVM code, none in Python)."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words, letters and patterns that must equal the reference's for like results.
LEGAL = ["wll", "llc", "qsc", "qpsc", "qfc", "spc", "wpc", "psc", "plc", "ltd", "limited", "co", "company", "est", "establishment", "corp", "corporation", "holding", "holdings", "group", "grp", "intl", "international", "trdg", "trad"]
ABBREVIATIONS = {
    "trdg": "trading", "trad": "trading", "constr": "construction", "const": "construction", "contg": "contracting", "cont": "contracting", "mfg": "manufacturing", "ind": "industries", "inds": "industries",
    "indl": "industrial", "svcs": "services", "svc": "services", "serv": "services", "tech": "technology", "eng": "engineering", "engg": "engineering", "equip": "equipment", "elec": "electrical",
    "mech": "mechanical", "transp": "transport", "trnsp": "transport", "maint": "maintenance", "gen": "general", "intl": "international", "dev": "development", "mgmt": "management", "sol": "solutions",
    "solns": "solutions", "med": "medical", "phar": "pharmacy", "rest": "restaurant", "cnt": "centre", "ctr": "centre", "center": "centre", "est": "establishment",
}
NOISE = [
    r"\bref\s*[:#]?\s*\w+\b", r"\btrf\s+(from|to)\b", r"\btransfer\s+(from|to)\b", r"\bpayment\s+(from|to)\b", r"\binward\s+remittance\b", r"\boutward\s+remittance\b", r"\bsalary\b",
    r"\bcheque\s*no\b", r"\bchq\b", r"\bvalue\s*date\b", r"\binv(oice)?\s*no\.?\s*\w+\b", r"\b\d{6,}\b", r"\bqa\d{2}[a-z0-9]{10,}\b",
]
STOPWORDS = ["the", "of", "and", "for", "al", "el"]
ARABIC_LETTER = "[ء-يٱ-ۓ]"
DIACRITICS = "[ؐ-ًؚ-ٰٟۖ-ۭ]"
FOLDED = ("أإآٱىئةؤیک", "ااااييهويك")
ARABIC_DROP = ["ذمم", "شمق", "شمعق", "ششو", "شمخ", "شمع", "شركه", "موسسه", "مجموعه", "ذات", "مسووليه", "محدوده", "قابضه", "القابضه", "و"]
ARTICLE = "^(?:وال|بال|كال|فال|لل|ال)(?=..)"
TRANSLATED = {
    "تجاره": "trading", "تجاريه": "trading", "مقاولات": "contracting", "خدمات": "services", "نقليات": "transport", "نقل": "transport", "هندسه": "engineering", "هندسيه": "engineering",
    "صناعه": "industries", "صناعات": "industries", "صناعيه": "industrial", "طباعه": "printing", "تنظيف": "cleaning", "سياحه": "tourism", "سفر": "travel", "استشارات": "consulting",
    "تكنولوجيا": "technology", "تقنيه": "technology", "معدات": "equipment", "اغذيه": "food", "ضيافه": "hospitality", "توريدات": "supplies", "تسويق": "marketing", "وكالات": "agencies",
    "الكترونيات": "electronics", "مواد": "materials", "بناء": "building", "عقارات": "real estate", "تجميل": "beauty",
}
LETTERS = {
    "ا": "a", "ب": "b", "ت": "t", "ث": "th", "ج": "j", "ح": "h", "خ": "kh", "د": "d", "ذ": "dh", "ر": "r", "ز": "z", "س": "s", "ش": "sh", "ص": "s", "ض": "d", "ط": "t", "ظ": "z", "ع": "a",
    "غ": "gh", "ف": "f", "ق": "q", "ك": "k", "ل": "l", "م": "m", "ن": "n", "ه": "h", "و": "w", "ي": "y", "ء": "", "پ": "p", "چ": "ch", "ڤ": "v", "گ": "g",
}
BUYER_WORDS = ["buyer", "buyers", "customer", "customers", "receivable", "receivables", "sales", "debtor", "inflow", "in", "sold", "sell", "seller"]
SUPPLIER_WORDS = ["supplier", "suppliers", "vendor", "vendors", "payable", "payables", "purchase", "purchases", "creditor", "outflow", "out", "bought", "buy"]
STAGES = {"awarded companies": "awarded", "technical/financial opened": "technical_financial", "technically opened": "technical", "financially opened": "financial"}
SECTIONS = {  # kind: (path, family, state)
    "available": ("AvailableMinistriesTenders", "tender", "published"), "closed": ("ClosedTenders", "tender", "closed"), "technical": ("TechnicallyOpenedTenders", "tender", "technical"),
    "financial": ("FinanciallyOpenedTenders", "tender", "financial"), "awarded": ("AwardedTenders", "tender", "awarded"), "cancelled": ("CancelledTenders", "tender", "cancelled"), "future": ("FutureTenders", "tender", "future"),
    "bids-available": ("AvailableMinistriesBids", "bid", "published"), "bids-closed": ("ClosedBids", "bid", "closed"), "bids-technical": ("TechnicallyOpenedBids", "bid", "technical"),
    "bids-financial": ("FinanciallyOpenedBids", "bid", "financial"), "bids-awarded": ("AwardedBids", "bid", "awarded"), "bids-cancelled": ("CancelledBids", "bid", "cancelled"), "bids-future": ("FutureBids", "bid", "future"),
}
STATE_RANK = {"future": 0, "published": 1, "closed": 2, "technical": 3, "financial": 4, "awarded": 5, "cancelled": 6}
REJECTION_MARKS = ["The requested URL was rejected", "Your support ID is"]
# End of the fixed values.

#: What each of NOISE needs, in ASCII texts in small letters: none of them finds anything where this doesn't.
NOISY = "re(?:f|mittance)|tr(?:f|ansfer)|payment|salary|ch(?:eque|q)|value|inv|[0-9]{6}|qa[0-9]{2}"
ARABIC_DIGITS = ("٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹", "0123456789" * 2)


def _accent_table() -> tuple[str, str]:
    """Accented Latin and full-width letters and their plain letter, from the character database."""
    pairs = []
    for n in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)]:
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(n)) if not unicodedata.combining(c))
        if len(plain) == 1 and plain != chr(n):
            pairs.append((chr(n), plain))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _accent_table()


def literal_map(d: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for kv in d.items() for x in kv))


def one_of(words: list[str]) -> str:
    return "(?:" + "|".join(words) + ")"


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def is_arabic(c: Column) -> Column:
    """At least two Arabic letters; false for null."""
    return F.coalesce(~is_ascii(c) & c.rlike(f"{ARABIC_LETTER}[^{ARABIC_LETTER[1:]}*{ARABIC_LETTER}"), F.lit(False))


def strip_accents(c: Column) -> Column:
    """Accents of Latin letters off (composed or not)."""
    return F.regexp_replace(F.translate(c, ACCENTED, PLAIN), r"\p{Mn}+", "")


def fold_arabic(c: Column) -> Column:
    """Marks off, letter variants one, dots between letters off, digits ASCII, all else blanks."""
    s = F.translate(F.translate(F.regexp_replace(c, DIACRITICS, ""), FOLDED[0] + "ـ", FOLDED[1]), *ARABIC_DIGITS)
    return F.regexp_replace(F.regexp_replace(s, r"(?<=[؀-ۿ])\.(?=[؀-ۿ])", ""), "[^ء-ي0-9 ]+", " ")


def _words(c: Column) -> Column:
    return F.filter(F.split(c, " +"), lambda w: w != "")


def normalize_arabic(c: Column) -> Column:
    """Folded Arabic name without legal forms, generic words and articles."""
    kept = F.filter(_words(fold_arabic(c)), lambda w: ~w.isin(ARABIC_DROP))
    bare = F.filter(F.transform(kept, lambda w: F.regexp_replace(w, ARTICLE, "")), lambda w: ~w.isin(ARABIC_DROP))
    return F.array_join(bare, " ")


def _letters(c: Column) -> Column:
    for a, b in LETTERS.items():
        if len(b) > 1:
            c = F.replace(c, F.lit(a), F.lit(b))
    one = {a: b for a, b in LETTERS.items() if len(b) == 1}
    return F.regexp_replace(F.translate(c, "".join(one), "".join(one.values())), r"[^a-z0-9 ]+", "")


def arabic_to_latin(c: Column, mode: str = "translate") -> Column:
    """Latin rendering: 'translate' (generic words in English, articles off) or 'letters' (letter by letter)."""
    kept = F.filter(_words(fold_arabic(c)), lambda w: ~w.isin(ARABIC_DROP))
    if mode == "translate":
        known = literal_map(TRANSLATED)
        bare = F.filter(F.transform(kept, lambda w: F.regexp_replace(w, ARTICLE, "")), lambda w: ~w.isin(ARABIC_DROP))
        kept = F.transform(bare, lambda w: F.coalesce(known[w], w))
    return F.trim(F.regexp_replace(_letters(F.array_join(kept, " ")), " +", " "))


def normalize_latin(c: Column, cheap: bool = False) -> Column:
    """cheap: c may be read more than once, so that most names, in ASCII and without a word of NOISE, are not searched for accents and each of its patterns."""
    s = F.lower(strip_accents(c))
    for pattern in NOISE:
        s = F.regexp_replace(s, "(?U)" + pattern, " ")
    if cheap:
        s = F.when(is_ascii(c) & ~F.lower(c).rlike(NOISY), F.lower(c)).otherwise(s)
    # What stands between is sought first, then looked around: most letters of a name are passed over.
    s = F.regexp_replace(s, r"\.(?<=\b[a-z]\.)(?=[a-z]\b)", "")
    s = F.regexp_replace(s, "[^a-z0-9 ]+", " ")
    s = F.trim(F.regexp_replace(s, r" (?<=\b[a-z] )(?=[a-z]\b)", ""))
    short = literal_map(ABBREVIATIONS)
    s = F.array_join(F.transform(F.split(s, " +"), lambda w: F.when(w.isin(*ABBREVIATIONS), short[w]).otherwise(w)), " ")
    s = F.regexp_replace(s, f"(?:(?:^| ){one_of(LEGAL)})+$", "")
    return F.trim(F.regexp_replace(F.regexp_replace(s, rf"(?<![^ ]){one_of(STOPWORDS)}(?![^ ])", ""), "  +", " "))


def normalize_name(c: Column) -> Column:
    """Comparison form of a name in its own script; '' for null."""
    return F.coalesce(F.when(is_arabic(c), normalize_arabic(c)).otherwise(normalize_latin(c, True)), F.lit(""))


def key_of(normal: Column) -> Column:
    """Sorted distinct words of a normalised name."""
    return F.array_join(F.sort_array(F.array_distinct(F.split(normal, " "))), " ")


def canonical_key(c: Column) -> Column:
    return key_of(normalize_name(c))


def match_keys(c: Column) -> Column:
    """The exact comparison keys of a name, without ''."""
    n = normalize_name(c)
    return F.array_distinct(F.filter(F.array(n, key_of(n)), lambda k: k != ""))


def squeeze_skeleton(normal: Column) -> Column:
    """Vowels and repeated letters of a word off, words apart."""
    s = F.regexp_replace(F.regexp_replace(normal, "[aeiou]+", ""), r"([^ ])\1+", "$1")
    return F.trim(F.regexp_replace(s, " +", " "))


def consonant_skeleton(c: Column) -> Column:
    return squeeze_skeleton(F.when(is_arabic(c), arabic_to_latin(c)).otherwise(normalize_name(c)))


def skeleton_forms(c: Column) -> Column:
    """Skeletons without blanks: one for a Latin name, up to two for an Arabic one; [] for null."""
    run = lambda x: F.replace(squeeze_skeleton(normalize_latin(x)), F.lit(" "), F.lit(""))
    forms = F.when(is_arabic(c), F.array(run(arabic_to_latin(c)), run(arabic_to_latin(c, "letters")))).otherwise(F.array(run(normalize_latin(c))))
    return F.coalesce(F.array_distinct(F.filter(forms, lambda f: f.isNotNull() & (f != ""))), F.array().cast("array<string>"))


def split_cr(c: Column) -> Column:
    """struct(primary, secondary) of 'a | b'; blanks are null."""
    parts = F.split(c, r"\|")
    part = lambda i: F.nullif(F.trim(F.get(parts, F.lit(i))), F.lit(""))
    return F.struct(part(0).alias("primary"), part(1).alias("secondary"))


def cr_root(c: Column, qfc: bool = False) -> Column:
    """The part of a registration number that joins; qfc: numbers of the financial centre keep a prefix of their own."""
    s = F.regexp_replace(F.translate(c, *ARABIC_DIGITS), r"\.0+\s*$", "")
    s = F.regexp_replace(s, r"(?<=[0-9])[,٬،](?=[0-9]{3}(?![0-9]))", "")
    root = F.nullif(F.regexp_replace(F.regexp_extract(s, "[0-9]+", 0), "^0+", ""), F.lit(""))
    if not qfc:
        return root
    number = F.regexp_extract(F.trim(s), r"(?i)^qfc[\s/\-]*0*([0-9]+)\s*$", 1)
    return F.when(F.trim(s).rlike("(?i)^qfc"), F.when(number != "", F.concat(F.lit("QFC"), number))).otherwise(root)


def parse_money(c: Column) -> Column:
    return F.replace(F.regexp_extract(c, r"-?[\d,]+(?:\.\d+)?", 0), F.lit(","), F.lit("")).try_cast("double")


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def norm_label(c: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_replace(squeeze(c), ":+$", "")), F.lit(""))


def canonical_html(c: Column) -> Column:
    """Page text without scripts, styles and comments, blanks squeezed."""
    s = F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1>", "")
    return squeeze(F.regexp_replace(s, r"(?s)<!--.*?-->", ""))


def html_fingerprint(c: Column) -> Column:
    return F.sha2(canonical_html(c), 256)


def looks_rejected(c: Column) -> Column:
    hit = F.lit(False)
    for mark in REJECTION_MARKS:
        hit = hit | F.contains(c, F.lit(mark))
    return F.coalesce(hit, F.lit(False))


def kind_from_url(c: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind, (path, _, _) in reversed(SECTIONS.items()):
        out = F.when(F.contains(c, F.lit(f"/{path}/")) | F.regexp_replace(c, "/+$", "").endswith(f"/{path}"), F.lit(kind)).otherwise(out)
    return out


def kind_path(c: Column) -> Column:
    return F.coalesce(literal_map({k: v[0] for k, v in SECTIONS.items()})[c], c)


def last_listing_page(html: Column, path: str) -> Column:
    """The greatest page number that a page links to; null if none."""
    return F.array_max(F.transform(F.regexp_extract_all(html, F.lit(rf"/{path}/(\d+)"), 1), lambda x: x.try_cast("int")))


def direction(c: Column) -> Column:
    word = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}]", "")
    return F.when(word.isin(BUYER_WORDS), "buyer").when(word.isin(SUPPLIER_WORDS), "supplier").otherwise("counterparty")


def stage_for_heading(c: Column) -> Column:
    out = F.lit("unknown")
    for needle, stage in reversed(STAGES.items()):
        out = F.when(F.contains(norm_label(c), F.lit(needle)), stage).otherwise(out)
    return out


def companies_ref(tender_id: Column, state: Column) -> Column:
    return F.concat_ws("@", tender_id, F.coalesce(state, F.lit("")))


def clean_cell(c: Column) -> Column:
    """A spreadsheet cell as text: null is '', an integral float loses its tail, outer blanks go."""
    return F.coalesce(F.trim(F.regexp_replace(c.cast("string"), r"^\s*(-?\d+)\.0+\s*$", "$1")), F.lit(""))


def state_rank(c: Column) -> Column:
    return F.coalesce(F.create_map(*(F.lit(x) for kv in STATE_RANK.items() for x in kv))[c], F.lit(-1))
