"""Formulas: one spelling of TeX, and TeX as plain Unicode text.  Row-local kernels."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

# fixed values: commands that mean the same, replaced one after the other in this order
SYNONYMS = [("\\rbrack ", "] "), ("\\lbrack ", "[ "), ("\\lbrace ", "\\} "), ("\\rbrace ", "\\{ "), ("\\lnot ", "\\neg "), ("\\land ", "\\wedge "), ("\\vee ", "\\lor "), ("\\doublecup ", "\\Cup "), ("\\doublecap ", "\\Cap "), ("\\llless ", "\\lll "), ("\\gggtr ", "\\ggg "), ("\\doteqdot ", "\\Doteq "), ("\\ne ", "\\neq "), ("\\le ", "\\leq "), ("\\ge ", "\\geq "), ("\\leftarrow ", "\\gets "), ("\\rightarrow ", "\\to "), ("\\restriction ", "\\upharpoonright "), ("\\owns ", "\\ni "), ("\\textlnot ", "\\neg "), ("\\textellipsis ", "\\ldots "), ("\\textbullet ", "\\bullet "), ("\\plusmn ", "\\pm "), ("\\texttimes", "\\times"), ("\\textmu", "\\mu"), ("\\textendash", "-"), ("\\textemdash", "---"), ("\\>", "\\:"), ("\\medspace", "\\:"), ("\\thinspace", "\\,"), ("\\negthinspace", "\\!"), ("\\thickspace", "\\;")]
# fixed values: style commands that go, in this order
STYLES = ["\\displaystyle", "\\scriptstyle", "\\scriptscriptstyle", "\\textstyle"]
# fixed values: command names and their characters in match order; a name also matches where it only opens a longer one
SYMBOLS = """
alpha α beta β gamma γ delta δ epsilon ε zeta ζ eta η theta θ iota ι kappa κ lambda λ mu μ nu ν xi ξ omicron ο pi π rho ρ sigma σ tau τ upsilon υ phi φ chi χ psi ψ omega ω
Gamma Γ Delta Δ Theta Θ Lambda Λ Xi Ξ Pi Π Sigma Σ Phi Φ Psi Ψ Omega Ω varepsilon ε vartheta ϑ varpi ϖ varrho ϱ varsigma ς varphi φ
times × div ÷ pm ± mp ∓ cdot · ast ∗ star ⋆ circ ∘ bullet • oplus ⊕ otimes ⊗ odot ⊙ cap ∩ cup ∪ wedge ∧ vee ∨ dagger † ddagger ‡ amalg ⨿ setminus ∖ wr ≀ diamond ⋄
bigtriangleup △ bigtriangledown ▽ triangleleft ◁ triangleright ▷ lhd ⊲ rhd ⊳ unlhd ⊴ unrhd ⊵
leq ≤ geq ≥ neq ≠ approx ≈ equiv ≡ cong ≅ sim ∼ simeq ≃ subset ⊂ supset ⊃ subseteq ⊆ supseteq ⊇ in ∈ ni ∋ notin ∉ propto ∝ parallel ∥ perp ⊥ mid ∣ prec ≺ succ ≻ preceq ⪯ succeq ⪰ ll ≪ gg ≫ doteq ≐ bowtie ⋈ asymp ≍ vdash ⊢ dashv ⊣ models ⊨
leftarrow ← rightarrow → Leftarrow ⇐ Rightarrow ⇒ leftrightarrow ↔ Leftrightarrow ⇔ mapsto ↦ uparrow ↑ downarrow ↓ updownarrow ↕ nearrow ↗ searrow ↘ swarrow ↙ nwarrow ↖ longleftarrow ⟵ longrightarrow ⟶ Longleftarrow ⟸ Longrightarrow ⟹ longleftrightarrow ⟷ Longleftrightarrow ⟺ longmapsto ⟼ hookrightarrow ↪ hookleftarrow ↩
sum ∑ prod ∏ coprod ∐ int ∫ oint ∮ bigcap ⋂ bigcup ⋃ bigvee ⋁ bigwedge ⋀ bigoplus ⨁ bigotimes ⨂ iint ∬ iiint ∭ iiiint ⨌
frac12 ½ frac14 ¼ frac34 ¾ frac13 ⅓ frac23 ⅔ frac15 ⅕ frac25 ⅖ frac35 ⅗ frac45 ⅘ frac16 ⅙ frac56 ⅚ frac18 ⅛ frac38 ⅜ frac58 ⅝ frac78 ⅞ sqrt √
infty ∞ nabla ∇ partial ∂ forall ∀ exists ∃ nexists ∄ emptyset ∅ varnothing ∅ therefore ∴ because ∵ ldots … cdots ⋯ vdots ⋮ ddots ⋱ aleph ℵ Re ℜ Im ℑ wp ℘ prime ′ backprime ‵ square □ blacksquare ■ bigcirc ○ blacktriangledown ▼ blacktriangle ▲ blacktriangleright ▶ blacktriangleleft ◀ diamondsuit ♦ heartsuit ♥ clubsuit ♣ spadesuit ♠ neg ¬ flat ♭ natural ♮ sharp ♯ angle ∠ measuredangle ∡ sphericalangle ∢ top ⊤ bot ⊥ ell ℓ hbar ℏ triangle △ vartriangle △ triangledown ▽
""".split()
SYMBOL_OF = dict(zip(SYMBOLS[::2], SYMBOLS[1::2], strict=True))
# fixed values
SPACES = {"enspace", "quad", "qquad", "thinspace", "medspace", "thickspace", ",", ":", ";"}
STACKED = {"overset", "underset", "stackrel"}
ACCENTS = {"\u0301": "\\'", "\u0300": "\\`", "\u0302": "\\^", "\u0308": '\\"', "\u0303": "\\~", "\u0327": "\\c ", "\u030c": "\\v "}

_SYMBOL = re.compile(r"\\(" + "|".join(SYMBOL_OF) + ")")
_NAME = re.compile(r"[A-Za-z]+")


def _bare(math: str) -> str:
    """Without one pair of math delimiters; a lone dollar counts as one."""
    math = math.strip()
    for marks, width in ((("\\(", "\\[", "$$"), 2), (("$",), 1)):
        if math.startswith(marks):
            math = math[width:]
            break
    for marks, width in ((("\\)", "\\]", "$$"), 2), (("$",), 1)):
        if math.endswith(marks):
            math = math[:-width]
            break
    return math.strip()


def _one_line(tex: str) -> str:
    """Comments end a line, lines are joined by blanks; a comment on the last line stays."""
    *lines, last = tex.split("\n")
    cut = [re.match(r"(?:[^%]|(?<=\\)%)*", line)[0] for line in lines]
    return " ".join([*cut, last])


def one_spelling(tex: str) -> str:
    for old, new in SYNONYMS:
        tex = tex.replace(old, new)
    return tex


def normalize_tex(math: str | None, inline: bool) -> str | None:
    """One formula on one line, in one spelling, without styles, in inline or display delimiters; empty stays empty."""
    if math is None:
        return None
    tex = _bare(math)
    if not tex:
        return ""
    tex = one_spelling(_one_line(tex))
    for style in STYLES:
        tex = tex.replace(style, "")
    return rf"\({tex}\)" if inline else rf"\[{tex}\]"


def to_tex(text: str | None) -> str | None:
    """Non-ASCII characters as TeX commands where a symbol or an accent names them, else folded to ASCII or dropped."""
    if text is None:
        return None
    names = {c: n for n, c in reversed(list(SYMBOL_OF.items())) if not n.startswith("frac")}
    out = []
    for c in text.strip():
        parts = unicodedata.normalize("NFD", c)
        if c.isascii():
            out.append(c)
        elif c in names:
            out.append(f"\\{names[c]} ")
        elif len(parts) == 2 and parts[0].isascii() and parts[1] in ACCENTS:
            out.append(ACCENTS[parts[1]] + parts[0])
        else:
            out.append(unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode())
    return one_spelling("".join(out))


def with_symbols(tex: str) -> str:
    """Commands as characters, the first in SYMBOLS whose name stands after the backslash; inline delimiters go."""
    return _SYMBOL.sub(lambda m: SYMBOL_OF[m[1]], tex).replace("\\(", "").replace("\\)", "")


def _closing(tex: str) -> dict[int, int]:
    """Positions of matched braces, both ways; escaped braces do not count."""
    open_, pairs, k = [], {}, 0
    while k < len(tex):
        if tex[k] == "\\" and tex[k + 1 : k + 2] in ("{", "}"):
            k += 1
        elif tex[k] == "{":
            open_.append(k)
        elif tex[k] == "}" and open_:
            pairs[k] = open_.pop()
            pairs[pairs[k]] = k
        k += 1
    return pairs


def plain_formula(tex: str) -> str:
    """Contents of a formula without commands, grouping braces and script marks; escaped brackets stay as brackets.

    One scan: spacing commands become a blank, stacked forms keep their base,
    ``\\left`` and ``\\right`` their delimiter, all other commands their arguments.
    """
    pairs, out, k, n = _closing(tex), [], 0, len(tex)
    while k < n:
        c = tex[k]
        if c == "\\":
            name = _NAME.match(tex, k + 1)
            follow = tex[k + 1 : k + 2]
            if name is None:
                out.append(" " if follow in SPACES and follow else follow if follow in "{}[]()" else "")
                k += 2 if follow in SPACES or follow in "{}[]()" and follow else 1
                continue
            word, k = name[0], name.end()
            if word in SPACES:
                out.append(" ")
            elif word in STACKED and tex[k : k + 1] == "{" and k in pairs and tex[pairs[k] + 1 : pairs[k] + 2] == "{":
                k = pairs[k] + 1
            elif word.startswith(("left", "right")):
                out.append(word.removeprefix("left") if word.startswith("left") else word.removeprefix("right"))
            elif tex[k : k + 1] == "*":
                k += 1
        else:
            if c not in "^_" and not (c in "{}" and k in pairs):
                out.append(c)
            k += 1
    return "".join(out)


def _between(text: str, start: str, end: str, change: Callable[[str], str]) -> str:
    out, at = [], 0
    while (a := text.find(start, at)) >= 0 and (b := text.find(end, a + len(start))) >= 0:
        out += [text[at:a], change(text[a + len(start) : b])]
        at = b + len(end)
    return "".join([*out, text[at:]])


def _between_lone(text: str, change: Callable[[str], str]) -> str:
    """Text between dollars that have no dollar beside them, taken in pairs."""
    lone = [k for k, c in enumerate(text) if c == "$" and text[k - 1 : k] != "$" and text[k + 1 : k + 2] != "$"]
    out, at = [], 0
    for a, b in zip(lone[::2], lone[1::2], strict=False):
        out += [text[at:a], change(text[a + 1 : b])]
        at = b + 1
    return "".join([*out, text[at:]])


def plain_formulas(text: str | None) -> str | None:
    """A text with all formulas as Unicode text: display, inline, single-dollar, then double-dollar spans."""
    if text is None:
        return None
    change = lambda tex: plain_formula(with_symbols(tex))
    text = _between(_between(text, "\\[", "\\]", change), "\\(", "\\)", change)
    return _between(_between_lone(text, change), "$$", "$$", change)


def _spans(text: str, open_: str, close: str) -> list[str]:
    """Stripped contents, of one character at least, from ``open_`` to the first ``close`` that no backslash escapes."""
    out, at = [], 0
    while (a := text.find(open_, at)) >= 0:
        b = text.find(close, a + len(open_) + 1)
        while b >= 0 and text[b - 1] == "\\":
            b = text.find(close, b + 1)
        if b < 0:
            at = a + 1
            continue
        out.append(text[a + len(open_) : b].strip())
        at = b + len(close)
    return out


def bodies(text: str | None) -> list[str] | None:
    """All formula bodies, inline forms first; a double dollar also fires the single-dollar form."""
    if text is None:
        return None
    return [x for marks in (("$", "$"), ("\\(", "\\)"), ("$$", "$$"), ("\\[", "\\]")) for x in _spans(text, *marks)]


def _taken(text: str, open_: str, close: str, least: int, one_line: bool, to_end: bool = False) -> tuple[str, list[str]]:
    """The text without its spans, and their contents of ``least`` characters or more; an open span may run to the end."""
    rest, found, at, seek = [], [], 0, 0
    while (a := text.find(open_, seek)) >= 0:
        b = text.find(close, a + len(open_) + least)
        while b > a + len(open_) and one_line and text[b - 1] == "\\":
            b = text.find(close, b + 1)
        if b < 0 and to_end and len(text) - a - len(open_) >= least:
            b = len(text)
        if b < 0 or one_line and "\n" in text[a:b]:
            seek = a + 1
            continue
        rest.append(text[at:a])
        found.append(text[a + len(open_) : b])
        at = seek = min(len(text), b + len(close))
    return "".join([*rest, text[at:]]), found


def modalities(text: str | None) -> dict[str, str] | None:
    """text, math and tables of a page: inline formulas line by line with display ones behind them, table bodies, and the rest."""
    if text is None:
        return None
    text, inline = _taken(text, "\\(", "\\)", 0, True)
    text, display = _taken(text, "\\[", "\\]", 1, True)
    text, tables = _taken(text, "\\begin{tabular}", "\\end{tabular}", 1, False, to_end=True)
    return {"text": text.strip(), "math": "\n".join(inline) + "\n".join(display), "tables": "\n".join(tables)}
