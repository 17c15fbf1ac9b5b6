"""SQL snippets shared by the check queries (DuckDB dialect, RE2 patterns)."""

from __future__ import annotations

from docloom import constants as K

WS = r"[\s\x0B\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def trim(x: str) -> str:
    return f"trim({x}, ' ' || chr(9) || chr(10) || chr(13) || chr(11))"


def rep(x: str, pattern: str, to: str, flags: str = "g") -> str:
    p = pattern.replace("'", "''")
    t = to.replace("'", "''")
    return f"regexp_replace({x}, '{p}', '{t}', '{flags}')"


def ext(x: str, pattern: str, group: int = 1) -> str:
    p = pattern.replace("'", "''")
    return f"regexp_extract({x}, '{p}', {group})"


def match(x: str, pattern: str) -> str:
    p = pattern.replace("'", "''")
    return f"regexp_matches({x}, '{p}')"


def collapse(x: str) -> str:
    return trim(rep(x, WS + "+", " "))


def norm_ws(x: str) -> str:
    t = rep(x, r"\r\n?", "\n")
    t = rep(t, r"[ \t]+", " ")
    t = rep(t, r" \n", "\n")
    return trim(rep(t, r"\n{3,}", "\n\n"))


def one_line(x: str, n: int = 160) -> str:
    t = trim(rep(x, r"[ \t\n\x0B\f\r]+", " "))
    return f"CASE WHEN length({t}) > {n} THEN substr({t}, 1, {n - 3}) || '...' ELSE {t} END"


def slug(x: str, n: int = 60) -> str:
    t = f"trim({rep('lower(' + trim(x) + ')', '[^a-z0-9]+', '-')}, '-')"
    t = f"CASE WHEN {t} = '' THEN 'halaman' ELSE {t} END"
    return f"CASE WHEN length({t}) > {n} THEN trim(substr({t}, 1, {n}), '-') ELSE {t} END"


def uuid5(x: str) -> str:
    ns = K.DOCUMENT_NAMESPACE.replace("-", "")
    h = f"sha1(unhex('{ns}') || encode({x}))"
    variant = f"substr('89ab89ab89ab89ab', ('0x' || substr({h}, 17, 1))::INT + 1, 1)"
    return (
        f"substr({h},1,8) || '-' || substr({h},9,4) || '-5' || substr({h},14,3) || '-' || "
        f"{variant} || substr({h},18,3) || '-' || substr({h},21,12)"
    )


def host(u: str) -> str:
    return f"lower({ext(u, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)')})"


def hostname(u: str) -> str:
    return f"CASE WHEN {host(u)} <> '' THEN {host(u)} ELSE {u} END"


def path(u: str) -> str:
    return ext(u, "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)")


def url_query(u: str) -> str:
    return ext(u, r"^[^?#]*\?([^#]*)")


def extension(u: str) -> str:
    return f"lower({ext(path(u), r'[.]([^./]*)$')})"


def in_list(x: str, values: list[str]) -> str:
    return f"{x} IN (" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def entities(x: str) -> str:
    """The references that occur in the test pages; the ampersand goes last."""
    for e, c in [
        ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "),
        ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
    ]:
        x = f"replace({x}, '{e}', '{c}')"
    return x


def label(u: str) -> str:
    p = f"trim({path(u)}, '/')"
    return (
        f"CASE WHEN {p} = '' THEN ({hostname(u)}) || '-beranda' "
        f"ELSE list_extract(string_split({p}, '/'), -1) END"
    )


DOC_URL = "'https://' || source || '.example.com/dokumen/' || doc_id"


def words(p: str) -> str:
    return f"regexp_split_to_array({p}, '{WS}+')"


def noise(p: str, words: str) -> str:
    """The noise rules on a prepared line ``p`` and its word list, both plain columns."""
    q = lambda s: s.replace("'", "''")
    word = r"[\p{L}\p{M}\p{N}\p{Pc}]"
    prefixes = " OR ".join(f"starts_with({p}, '{q(x)}')" for x in K.NOISE_PREFIXES)
    return f"""({p} = '' OR ({p} NOT LIKE '%|%' AND regexp_matches({p}, '^[\\-–—_=*.·•~^\\\\s]+$'))
      OR {in_list(p, K.NOISE_LINES)}
      OR (len({words}) >= 2 AND regexp_matches({words}[1], '^[\\p{{L}}\\p{{N}}]+$') AND len(list_filter({words}[2:],
          lambda w: NOT (starts_with(w, {words}[1]) AND regexp_matches(substr(w, length({words}[1]) + 1), '^{word}*$')))) = 0)
      OR (len({words}) BETWEEN 2 AND 4 AND {words}[1] <> '' AND len(list_filter(
          list_transform({words}[2:], lambda w: regexp_replace(w, '[.…]+$', '')),
          lambda w: w <> '' AND (starts_with({words}[1], w) OR starts_with(w, {words}[1])))) > 0)
      OR (length({p}) <= 160 AND regexp_matches({p}, 'all rights reserved|Â©|©|\\bver(?:si)?[.]?{WS}*[0-9]+(?:[.][0-9]+)+'))
      OR regexp_matches({p}, '^[\\p{{L}}\\p{{N}}._%+\\-]+@[\\p{{L}}\\p{{N}}.\\-]+[.][\\p{{L}}]{{2,}}$')
      OR regexp_matches({p}, '^(?:jl[.]?|jalan){WS}+.{{0,80}}\\bno[.]?{WS}*[0-9]+')
      OR regexp_matches({p}, '^menampilkan{WS}+[0-9]+{WS}*[-–]{WS}*[0-9]+{WS}+dari{WS}+total{WS}+[0-9]+$')
      OR regexp_matches({p}, '^[0-9]+{WS}*/{WS}*(?:page|halaman)$')
      OR regexp_matches({p}, '^(?:[-*+]{WS}*)?[0-9]{{1,3}}$') OR {prefixes})"""


def plain_line(x: str) -> str:
    return f"lower({trim(rep(x, '^' + WS + '*(?:[-*+]|[0-9]+[.)])' + WS + '+', '', ''))})"


def replace_each(t: str, pattern: str, group: int, f) -> str:
    """Replace every match: split, capture, zip; ``f`` maps the SQL of a capture to SQL."""
    p = pattern.replace("'", "''")
    return (
        f"array_to_string(list_transform(list_zip(regexp_split_to_array({t}, '{p}'), "
        f"regexp_extract_all({t}, '{p}', {group})), lambda z: z[1] || CASE WHEN z[2] IS NULL THEN '' "
        f"ELSE {f('z[2]')} END), '')"
    )


def tidy_label(x: str) -> str:
    t = f"rtrim({rep(collapse(x), r'(?:[.][.][.]|…)+$', '')})"
    w = f"string_split({t}, ' ')"
    keep = (
        f"list_max(list_transform({w}, lambda v, i: CASE WHEN i > 1 AND NOT starts_with("
        f"lower({w}[1]), lower(v)) THEN i ELSE 1 END))"
    )
    return f"array_to_string({w}[1:{keep}], ' ')"


def fix_target(x: str) -> str:
    t = trim(f"replace({x}, '\\', '/')")
    return (
        f"CASE WHEN {t} = '' OR {t} LIKE '/%' OR {t} LIKE '#%' OR "
        f"regexp_matches({t}, '(?i)^[a-z][a-z0-9+.-]*:') THEN {t} ELSE '/' || {t} END"
    )


def block_kind(b: str) -> str:
    """``navigasi``, ``label`` or ``isi`` of a block held in SQL expression ``b``."""
    r = rep(b, r"\[[^\]\n]*\]\([^)\n]*\)", " ")
    r = rep(r, r"[#*_`>|~]+", " ")
    r = rep(r, rf"(?m)^{WS}*(?:[-*+]|[0-9]+[.)]){WS}+", " ")
    r = collapse(r)
    n = f"len(regexp_extract_all({b}, '\\]\\([^)\\n]*\\)'))"
    labels = f"regexp_extract_all({b}, '\\[([^\\]\\n]*)\\]\\([^)\\n]*\\)', 1)"
    targets = f"regexp_extract_all({b}, '\\]\\(([^)\\n]*)\\)', 1)"
    vocab = (
        f"(len({labels}) > 0 AND len(list_filter({labels}, lambda x: NOT "
        f"{in_list('lower(' + tidy_label('x') + ')', K.NOISE_LINES)})) = 0)"
    )
    contact = (
        f"len(list_filter({targets}, lambda x: NOT regexp_matches({trim('x')}, "
        f"'(?i)^(?:tel|mailto|sms|whatsapp):'))) = 0"
    )
    return f"""CASE WHEN {trim(b)} = '' OR regexp_matches({trim(b)}, '^#{{1,6}}{WS}') OR {trim(b)} LIKE '|%' THEN 'isi'
      WHEN {n} > 0 AND length({r}) <= {K.NAV_RESIDUE_CHARS} AND NOT regexp_matches({r}, '[.!?:;]$') THEN
        CASE WHEN length({r}) = 0 AND ({n} >= 2 OR {vocab} OR {contact}) THEN 'label' ELSE 'navigasi' END
      WHEN {n} = 0 AND length({r}) BETWEEN 1 AND {K.LABEL_CHARS} AND len(string_split({r}, ' ')) <= {K.LABEL_WORDS}
        AND (NOT regexp_matches({r}, '[0-9]') OR regexp_matches({r}, '^[0-9\\s()+\\-.,/–—]+$')) THEN 'label'
      ELSE 'isi' END"""
