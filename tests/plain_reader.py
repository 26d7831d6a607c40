"""Reading aloud text by text in plain Python, against which the Catalyst form is tested."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from itertools import groupby

from cliploom.functions import fixed_values as V
from cliploom.functions.reading import Style
from cliploom.functions.text import plain_characters


def roman_value(text: str) -> int | None:
    """The sum of roman digits, each less where a greater one stands behind it; None for other characters."""
    if not text or not set(text.upper()) <= V.ROMAN.keys():
        return None
    values = [V.ROMAN[c] for c in text.upper()]
    return sum(v if v == max(values[k:]) else -v for k, v in enumerate(values)) or None


def _any_of(words) -> str:
    return "|".join(map(re.escape, sorted(words, key=len, reverse=True)))


_PLAIN = str.maketrans(plain_characters())
_SEAM = re.compile(rf"{V.NON_SPEECH}|(?<=[^\W\d_])-(?=[^\W\d_])", re.IGNORECASE)


class Reader:
    def __init__(self, style: Style = Style()):
        self.style = style
        over = lambda base, extra: {k.lower(): v for k, v in base.items()} | {str(k).lower(): str(v) for k, v in extra.items()}
        self.letters, self.units = over(V.LETTERS, style.letters), over(V.UNITS, style.units)
        self.currencies, self.short = over(V.CURRENCIES, style.currencies), over(V.ABBREVIATIONS, style.abbreviations)
        self.symbols = V.SYMBOLS | style.symbols
        self.scales = [s.replace("nghìn", style.thousand) for s in V.SCALES]
        keys = {"number": V.NUMBER, "days": V.DAY_WORDS, "headings": V.HEADINGS, "units": _any_of(self.units), "currencies": _any_of(self.currencies), "short": _any_of(self.short)}
        fill = lambda pattern: re.sub(r"\{([a-z]+)\}", lambda m: keys[m[1]], pattern)
        #: Each form with what it reads as, by the method of its name; None leaves it as it is.
        self.forms = [(re.compile(fill(p), 0 if case else re.IGNORECASE), self._spaced(getattr(self, f"_{name}"))) for name, p, case in V.WRITTEN_FORMS if name != "acronym" or style.spell_acronyms]

    @staticmethod
    def _spaced(read: Callable) -> Callable:
        def out(m: re.Match) -> str:
            words = read(*m.groups())
            return m[0] if words is None else f" {words} "

        return out

    @staticmethod
    def _is_day(d: str, m: str) -> bool:
        return 0 < int(d) < 32 and 0 < int(m) < 13

    def _month(self, m: str) -> str:
        return self.style.four if int(m) == 4 else self.whole(m)

    def _abbreviation(self, t: str) -> str:
        return self.short.get(t.lower(), t)

    def _acronym(self, t: str) -> str:
        return " ".join(self.letters.get(c.lower(), c) for c in t)

    def _clock(self, h: str, m: str, s: str | None) -> str | None:
        parts = [(int(h), "giờ", 24), (int(m), "phút", 60), (int(s or 0), "giây", 60)]
        if any(v >= limit for v, _, limit in parts):
            return None
        return " ".join(f"{self.whole(v)} {name}" for k, (v, name, _) in enumerate(parts) if v or not k)

    def _hour_and_minute(self, h: str, m: str) -> str | None:
        return f"{self.whole(h)} giờ {self.whole(m)} phút" if int(h) < 24 and int(m) < 60 else None

    def _hour(self, h: str) -> str | None:
        return f"{self.whole(h)} giờ" if int(h) < 24 else None

    def _date(self, word: str | None, d: str, m: str, y: str) -> str | None:
        year = int(y) + (len(y) == 2) * (2000 if int(y) < 50 else 1900)
        return f"{word or 'ngày'} {self.whole(d)} tháng {self._month(m)} năm {self.whole(year)}" if self._is_day(d, m) else None

    def _day_of_month(self, word: str, d: str, m: str) -> str | None:
        return f"{word} {self.whole(d)} tháng {self._month(m)}" if self._is_day(d, m) else None

    def _month_of_year(self, m: str, y: str) -> str | None:
        return f"tháng {self._month(m)} năm {self.whole(y)}" if self._is_day("1", m) else None

    def _ordinal(self, k: str) -> str:
        return f"thứ {({1: 'nhất', 4: self.style.four}).get(int(k)) or self.whole(k)}"

    def _heading(self, word: str, digits: str) -> str | None:
        n = roman_value(digits) or 201
        return f"{word} {self.whole(n)}" if n <= 200 else None

    def _percent(self, x: str) -> str:
        return f"{self.number(x)} phần trăm"

    def _money(self, sign: str, x: str) -> str:
        return f"{self.number(x)} {self.symbols.get(sign, '').strip() or 'đơn vị'}"

    def _temperature(self, x: str, scale: str) -> str:
        return f"{self.number(x)} độ {'xê' if scale in 'cC' else 'ép'}"

    def _measure(self, x: str, unit: str) -> str:
        return f"{self.number(x)} {self.units.get(unit.lower(), unit)}"

    def _currency(self, x: str, name: str) -> str:
        return f"{self.number(x)} {self.currencies.get(name.lower(), name)}"

    def _range(self, low: str, high: str) -> str:
        return f"{self.number(low)} đến {self.number(high)}"

    def _fraction(self, a: str, b: str) -> str | None:
        if int(b) == 0:
            return None
        return f"{self.whole(a)} {'phần' if int(a) < int(b) <= 10 else 'trên'} {self.whole(b)}"

    def _plain(self, x: str) -> str:
        return self.number(x)

    def digits(self, text) -> str:
        return " ".join(V.DIGITS[int(c)] for c in str(text) if c.isdigit())

    def below_thousand(self, n: int, first: bool) -> str:
        """A group of three; not the first: its zero hundreds are read."""
        h, (t, u) = n // 100, divmod(n % 100, 10)
        words = [V.DIGITS[h], V.HUNDRED] if h or not first and n else []
        if t:
            words += [V.DIGITS[t], V.TENS] if t > 1 else [V.TEN]
        elif u and words:
            words.append(self.style.filler)
        after = {5: V.FIVE_AFTER_TEN} | ({1: V.ONE_AFTER_TENS, 4: self.style.four} if t > 1 else {})
        if u:
            words.append(after.get(u, V.DIGITS[u]) if t else V.DIGITS[u])
        return " ".join(words)

    def whole(self, value) -> str:
        """A whole number, given as one or in digits; with more groups than there are scales digit by digit."""
        text = str(value)
        if text.startswith("-"):
            return f"{V.MINUS} {self.whole(text[1:])}"
        text = text.lstrip("0")
        if not text:
            return V.DIGITS[0]
        n = -(-len(text) // 3)
        if n > len(self.scales):
            return self.digits(text)
        groups = [int(g) for g in re.findall("...", text.zfill(3 * n))]
        return " ".join(f"{self.below_thousand(g, not k)} {self.scales[n - 1 - k]}".strip() for k, g in enumerate(groups) if g)

    def number(self, token: str) -> str:
        """Grouped by dots or commas, with a fraction, plain, or digit by digit (a leading zero, ten digits or more, other forms)."""
        text = token.strip()
        if text.startswith("-"):
            return f"{V.MINUS} {self.number(text[1:])}"
        for mark, other in ((".", ","), (",", ".")):
            m = re.fullmatch(rf"(\d{{1,3}}(?:{re.escape(mark)}\d{{3}})+)(?:{re.escape(other)}(\d+))?", text)
            if m:
                body = m[1].replace(mark, "")
                return self._decimal(body, m[2]) if m[2] else self.whole(body)
        if m := re.fullmatch(r"(\d+)[.,](\d+)", text):
            return self._decimal(m[1], m[2])
        plain = re.fullmatch(r"0|[^\D0]\d{0,8}", text)
        return self.whole(text) if plain else self.digits(text)

    def _decimal(self, whole: str, part: str) -> str:
        return f"{self.whole(whole)} {V.POINT} {self.digits(part) if self.style.fraction_by_digit else self.whole(part)}"

    def clean_before(self, text: str) -> str:
        t = unicodedata.normalize("NFC", text).translate(_PLAIN)
        for sign, digit in V.SUPERSCRIPTS.items():
            t = t.replace("m" + sign, "m" + digit)
        return " ".join(_SEAM.sub(" ", re.sub(r"…{2,}|\.{3,}", "…", t)).split())

    def _kind(self, c: str) -> int:
        """0 nothing, 1 of a word, 2 a mark."""
        if c in self.style.punctuation:
            return 1 + (c in V.KEPT_PUNCTUATION)
        return int(c.isalpha() and "LATIN" in unicodedata.name(c, ""))

    def clean_after(self, text: str) -> str:
        """Words with a blank between them; of the marks between two words the first stays, behind the word before."""
        out, stopped = [], False
        for kind, run in groupby(text, self._kind):
            word = "".join(run)
            if kind == 1:
                out.append(word if word[0] in ";:" else " " + word)
            elif kind == 2 and not stopped:
                out.append(word[0])
            stopped = kind == 2 or stopped and not kind
        t = "".join(out).strip(" ,;:-")
        t = t.lower() if self.style.lowercase else t
        return t + "." if t and t[-1] not in ".!?…" else t

    def __call__(self, text: str | None) -> str:
        t = self.clean_before(text or "")
        if not t:
            return ""
        for form, read in self.forms:
            t = form.sub(read, t)
        for mark, words in self.symbols.items():
            t = t.replace(mark, words)
        return self.clean_after(re.sub(r"\d+", lambda m: f" {self.digits(m[0])} ", t))
