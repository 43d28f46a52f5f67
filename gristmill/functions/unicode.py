"""Unicode forms of names and how well a quotation fits a text. Only rows that the JVM can't decide are sent to Python, in Arrow batches."""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

#: CJK and typographic marks, brackets and hyphens that quotations are compared without.
MARKS = "，。、；：“”‘’（）[]【】《》「」-—…·"


def _mapped(text: Column, change) -> Column:
    @F.pandas_udf("string")
    def changed(values: pd.Series) -> pd.Series:
        return values.map(lambda v: v if v is None else change(v))

    return F.coalesce(changed(F.when(text.rlike(r"[^\x00-\x7F]"), text)), text)


def unicode_form(text: Column, form: str = "NFKC") -> Column:
    """The text in a Unicode normal form; ASCII texts stay in the JVM."""
    return _mapped(text, lambda v: unicodedata.normalize(form, v))


def without_accents(text: Column) -> Column:
    """The text without combining marks, composed again."""
    return _mapped(text, lambda v: unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFD", v) if unicodedata.category(c) != "Mn")))


def comparable(text: Column) -> Column:
    """Without white space and marks, lower-cased."""
    marks = "".join("\\" + c if c in "[]-" else c for c in MARKS)
    return F.lower(F.regexp_replace(text, rf"(?U)\s+|[{marks}]", ""))


def fit(quote: Column, text: Column, least: int = 5, share: int = 10) -> Column:
    """exact, normalised (equal without white space and marks), near (some place differs in at most one of so many characters, one at least), or none."""

    @F.pandas_udf("boolean")
    def near(quotes: pd.Series, texts: pd.Series) -> pd.Series:
        def one(q: str | None, t: str | None) -> bool:
            if q is None or t is None or len(q) < least or len(t) < len(q):
                return False
            a, b = (np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32) for x in (q, t))
            wrong = np.zeros(len(b) - len(a) + 1, np.int32)
            for k, c in enumerate(a):
                wrong += b[k : k + len(wrong)] != c
            return bool((wrong <= max(1, len(a) // share)).any())

        return pd.Series([one(q, t) for q, t in zip(quotes, texts, strict=True)])

    usable = F.coalesce((quote != "") & (text != ""), F.lit(False))
    q, t = comparable(quote), comparable(text)
    exact, normal = usable & F.contains(text, quote), usable & (q != "") & F.contains(t, q)
    rest = usable & ~exact & ~normal
    return F.when(exact, "exact").when(normal, "normalised").when(near(F.when(rest, q), F.when(rest, t)), "near").otherwise("none")
