"""Input shapes derived from the given tables, one SQL text for both engines.

Table and fixture names stand in braces; ``$`` macros hide the few spots where
the two SQL dialects differ.  All identifiers are invented.
"""

from __future__ import annotations

import re

_MACROS = {
    # text with every non-ASCII character folded, line breaks kept
    "ascii": {
        "spark": "regexp_replace({0}, '[^ -~\n]', 'x')",
        "duckdb": "regexp_replace({0}, '[^ -~\n]', 'x', 'g')",
    },
    "latin": {
        "spark": "regexp_replace({0}, '[^ -~\n¡-ÿ]', 'x')",
        "duckdb": "regexp_replace({0}, '[^ -~\n¡-ÿ]', 'x', 'g')",
    },
    "day": {
        "spark": "date_format({0}, 'dd-MM-yyyy')",
        "duckdb": "strftime({0}, '%d-%m-%Y')",
    },
    # Spark gets the number itself, see the registry
    "count": {"spark": "$rows({0})$", "duckdb": "(select count(*) from {0})"},
    "words": {
        "spark": "explode(split({0}, ' '))",
        "duckdb": "unnest(string_split({0}, ' '))",
    },
}


def _pad(width: int, number: str) -> str:
    return f"lpad(cast({number} as string), {width}, '0')"


def _case(selector: str, parts: list[str]) -> str:
    whens = " ".join(f"when {i} then {part}" for i, part in enumerate(parts))
    return f"case {selector} {whens} end"


_K, _C = "o_orderkey", "o_custkey"

_IDENTIFIERS = [
    f"concat('Konto DE12 3456 7890 1234 ', {_pad(4, f'{_K} % 10000')}, ' 42 bitte')",
    f"concat('Konto DE', {_pad(20, f'{_K} * 7 + 3')})",
    f"concat('Leasing LC', {_pad(4, f'{_K} % 10000')}, 'X', {_pad(8, _K)})",
    f"concat('Kredit CF', {_pad(12, f'{_K} * 13')})",
    f"concat('am ', cast({_K} % 31 + 1 as string), '.', cast({_K} % 12 + 1 as string), '.2020')",
    f"concat('zum 1.', {_pad(2, f'{_K} % 12 + 1')}, '.', cast(10 + {_K} % 90 as string), ' erledigt')",
    f"concat('Ausweis CFGHK', {_pad(4, f'{_K} % 10000')})",
    f"concat('Steuer 1', cast({_K} % 10 as string), '1/', {_pad(3, f'{_K} % 1000')}, '/', {_pad(5, _K)})",
    f"concat('Steuer-ID=> 49 166 582 ', {_pad(3, f'{_K} % 1000')}, ',', '1', {_pad(10, _C)})",
    f"concat('Tel 0', cast(171 + {_K} % 20 as string), ' ', {_pad(7, _K)})",
    f"concat('Tel +49 89 ', {_pad(6, _K)}, '-', cast({_K} % 100 as string))",
    f"concat('Fax (089) 12345-', cast({_K} % 100 as string), ' ab 9 Uhr')",
    f"concat('Mail kunde', cast({_C} as string), '@mail.example an uns')",
    f"concat('Fahrgestell WABX2', {_pad(12, f'{_K} * 3')})",
    f"concat('Fahrzeug AB', {_pad(5, _K)})",
    f"concat('Kennz. DON-Z', cast({_K} % 9000 + 1000 as string), ' verkauft')",
    f"concat('Mitarbeiter Q ', {_pad(6, _K)}, ' und q-1', {_pad(4, f'{_K} % 10000')})",
    f"concat('in 8', {_pad(4, f'{_K} % 10000')}, ' Musterstadt')",
    "'in 01067 Musterdorf'",
    f"concat('Nr ', cast(100000 + {_K} as string))",
    f"concat('Nr ', cast(1000000 + {_K} as string))",
    f"concat('Nr ', cast(11111111 + {_K} as string))",
    f"concat('Nr ', cast(222222222 + {_K} as string))",
    f"concat('Nr ', cast(3333333333 + {_K} as string))",
    f"concat('siehe <https://www.mail.example/pfad?id=', cast({_K} as string), '> dort')",
    "'auf www.seite.example/hilfe/a oder hilfe.seite'",
    "'Nr 1234 LC12X9 CF12 99.13. a@b X1Y2 QQ 12 DE12 34'",
    "concat('Page 1 Kopf', '\n', 'Betreff: Alt Betreff: Frage')",
]

_SALUTATIONS = [
    "'Sehr geehrte Damen und Herren,'", "'Geehrte Damen und Herren'",
    "'Sehr geehrtes Team Musterbank,'", "'Werte Damen und Herren'",
    "'Sehr geehrte Herr Muster'", "'Lieber Herr Muster'", "'Sehr geehrte Frau Dr. Beispiel'",
    "'Sehr geehrte Kollegen'", "'Sehr geehrter Herr Prof. Dr. Beispiel'", "'Guten Tag'",
    "'Guten Tag zusammen'", "'Guten Morgen'", "'Guten Abend Dipl.-Ing. (FH) Beispiel'",
    "'Hallo zusammen'", "'Hallo Team Musterbank'", "'Hallo Kundenbetreuung'", "'Hallo!'",
    "'Hallo'", "'Dear Sir/Madam'", "'an Ph.D. Beispiel und Mag. Muster'",
]
_CLOSINGS = [
    "'Herzliche Grüße'", "'Mit freundlichen Grüßen'", "'Mit besten Grüßen'", "'Beste Grüße'",
    "'Mit freundlichem Gruß'", "'Viele Grüße'", "'Best regards'", "'Regards'", "'MfG'",
    "'MFG'", "'Danke'",
]
_FOOTERS = [
    "' Diese Nachricht wurde vom Mobiltelefon gesendet'",
    "' gesendet mit der Muster App'",
    "' Von meinem Telefon gesendet'",
    "' Am 11.05.20, 13:20 schrieb service@bank.example: alter Text'",
    "' ----- ### __=__ Ende'",
    "''",
]
_SENDERS = [
    "concat('Kunde ', cast({k} as string), ' <kunde', cast({k} as string), '@gmx.de>')",
    "concat('kunde', cast({k} as string), '@WEB.de')",
    "concat('Firma <info', cast({k} as string), '@firma.example>')",
    "'System <noreply@bank.example>'",
    "'service@bank.example'",
    "concat('partner', cast({k} as string), '@partner.bank.example')",
    "cast(null as string)",
    "concat('privat', cast({k} as string), '@t-online.de')",
]

_INDEX_ITEMS = [
    "concat('Klasse', cast(o_orderkey % 3 as string))",
    "'Inhalt'",
    "'{{Batch ID}}'", _pad(6, "100000 + o_orderkey % 90000"),
    "'{{Document ID}}'", _pad(7, "1000000 + o_orderkey"),
    "'DocumentType'", "concat('Typ', cast(o_custkey % 25 as string))",
    "'ClassificationResultWithConfiden'",
    "concat('Typ', cast(o_custkey % 25 as string), ';0.', cast(o_orderkey % 90 + 10 as string), ';A1|"
    "Typ', cast(o_orderkey % 25 as string), ';0.', cast(o_custkey % 90 + 10 as string), ';B2')",
    "'PageCount'",
    "case when o_orderkey % 17 = 0 then '' else cast(o_orderkey % 13 + 1 as string) end",
    "'{{Document Count}}'", "cast(o_orderkey % 4 + 1 as string)",
    "'{{$InputChannel}}'", "case when o_custkey % 2 = 0 then 'Mail' else 'Scan' end",
    "'{{$sourceSystem}}'", "concat('Quelle', cast(o_custkey % 5 as string))",
]
_AUTOCLASS = (
    "case when o_orderkey % 5 = 0 then '' else concat(',\"AutoClassificationConfidence\",\"', "
    "cast(o_orderkey % 2 as string), '\"') end"
)

FIXTURES = {
    "fx_documents": "select doc_id, lang, source, $ascii(text)$ as text from {documents}",
    "fx_pii": (
        f"select {_K} as doc_key, concat(case when {_K} % 3 = 0 then ' ' else '' end, 'Text ', "
        f"{_case(f'{_K} % 28', _IDENTIFIERS)}, ' und ', {_case(f'({_K} * 5 + {_C}) % 28', _IDENTIFIERS)}, "
        "' danke ') as text from {orders}"
    ),
    "fx_mail": (
        "select case when o.o_orderkey % 997 = 3 then cast(null as string) "
        "else concat('M', cast(case when o.o_orderkey % 50 in (0, 1) then o.o_orderkey - o.o_orderkey % 50 "
        "else o.o_orderkey end as string)) end as message_id, "
        f"$day(o.o_orderdate)$ as date, concat({_pad(2, 'o.o_orderkey % 24')}, ':', {_pad(2, 'o.o_orderkey % 60')}, "
        f"':', {_pad(2, 'o.o_orderkey * 7 % 60')}) as time, "
        + _case("o.o_custkey % 8", _SENDERS).replace("{k}", "o.o_custkey") + " as sender, "
        "case substr(o.o_orderpriority, 1, 1) when '1' then 'Kontaktanfrage Internet Auftritt Banking' "
        "when '2' then 'Eingang einer Kontaktanfrage' "
        "when '3' then concat('Frage', '\n', 'zu Vertrag ', cast(100000 + o.o_orderkey as string), ' --- ', '\t', 'eilt') "
        "when '4' then cast(null as string) "
        "else concat('Antwort kunde', cast(o.o_custkey as string), '@mail.example #= ', c.c_name) end as subject, "
        f"concat('Betr. ', {_case('o.o_orderkey % 20', _SALUTATIONS)}, '\n', d.text, '\n', "
        f"{_case('o.o_orderkey % 11', _CLOSINGS)}, '\t', {_case('o.o_orderkey % 6', _FOOTERS)}) as body, "
        "case o.o_orderkey % 4 when 0 then 'utf-8' when 1 then 'unknown' when 2 then 'ISO-8859-1' "
        "else cast(null as string) end as encoding, "
        "o.o_orderkey % 12 as file_seq, o.o_orderkey as row_seq "
        "from {orders} o join {customer} c on o.o_custkey = c.c_custkey "
        "join {fx_documents} d on d.doc_id = o.o_orderkey % $count(documents)$"
    ),
    "fx_index": (
        f"select {_pad(8, 'o_orderkey')} as doc_key, concat(case when o_orderkey % 7 = 0 then '﻿' else '' end, "
        + ", ',', ".join(f"'\"', {item}, '\"'" for item in _INDEX_ITEMS)
        + f", {_AUTOCLASS}) as indexstring from {{orders}}"
    ),
    "fx_body": (
        f"select {_pad(8, 'o.o_orderkey')} as doc_key, concat('﻿', 'Muster Finanzdienste Musterbank GmbH ', "
        f"{_case('o.o_orderkey % 20', _SALUTATIONS)}, ' ', d.text, '\n', {_case('o.o_orderkey % 11', _CLOSINGS)}) as rawbody "
        "from {orders} o join {fx_documents} d on d.doc_id = o.o_orderkey % $count(documents)$ where o.o_orderkey % 11 <> 0 "
        f"union all select concat('X', {_pad(7, 'doc_id')}) as doc_key, text as rawbody from {{fx_documents}}"
    ),
    "fx_report": (
        "select 100000 + o_orderkey % 90000 as stapel_id, cast(o_custkey % 2 as int) as automatisch_klassifiziert, "
        "o_orderstatus as status from {orders} where o_orderkey % 10 < 8 "
        "union all select 100000 + o_orderkey % 90000 as stapel_id, cast(0 as int) as automatisch_klassifiziert, "
        "'zweit' as status from {orders} where o_orderkey % 10 = 3"
    ),
    # the text each undecoded body holds; the bytes follow from it
    "fx_plain": (
        "select doc_id as doc_key, case doc_id % 4 when 3 then $ascii(text)$ else $latin(text)$ end as text, "
        "cast(doc_id % 4 as int) as variant, "
        "case doc_id % 7 when 1 then cast(null as string) when 2 then 'unknown' when 3 then 'nonsense-8' "
        "else (case doc_id % 4 when 2 then 'ISO-8859-1' else 'UTF-8' end) end as encoding from {documents}"
    ),
    "fx_blocklist": (
        "select concat('kunde', cast(c_custkey as string), '@GMX.de') as token from {customer} where c_custkey % 97 = 0 "
        "union all select word as token from (select $words(text)$ as word from {fx_documents}) w "
        "group by word having count(*) = 1 and length(word) > 12"
    ),
    "fx_senders": (
        "select 'System <noreply@bank.example>' as token union all select 'service@bank.example' as token "
        "union all select concat('partner', cast(c_custkey as string), '@partner.bank.example') as token "
        "from {customer} where c_custkey % 4 = 1"
    ),
    "fx_allowed": (
        "select concat('Typ', cast(n_nationkey as string)) as token from {nation} where n_nationkey < 20"
    ),
    "fx_words": (
        "select distinct word as token from (select $words(text)$ as word from {fx_documents}) w where word <> ''"
    ),
    "fx_first_name": "select token from {fx_words} where token like 'th%' or token like 'an%'",
    "fx_surname": "select token from {fx_words} where token like 'and%' or token like 'er%'",
    "fx_city": (
        "select concat(n_name, ' ') as token from {nation} union all "
        "select token from {fx_words} where token like 'the%' or token like 'on%'"
    ),
    "fx_street": "select distinct p_name as token from {part} union all select token from {fx_words} where token like 'st%'",
    "fx_postcode": (
        f"select distinct {_pad(5, 'o_orderkey % 90000 + 80000')} as token from {{orders}} union all select 'NATION_1' as token"
    ),
    "fx_stop": "select lower(r_name) as token from {region} union all select token from {fx_words} where token like 'ere%'",
    "fx_archive": (
        "select concat('F', cast(l_orderkey as string)) as file, l_orderkey as order_key, "
        "l_linenumber % 2 as proc, l_linenumber as line, "
        "concat('D', cast(l_linenumber - l_linenumber % 3 as string)) as doc_id, "
        "case when max(l_returnflag) = 'R' then '1' else '0' end as is_body, max(l_partkey) as part "
        "from {lineitem} group by l_orderkey, l_linenumber"
    ),
    # the same documents in 64 archives
    "fx_bins": (
        "select concat('F', cast(order_key % 64 as string)) as file, order_key % 64 as order_key, proc, "
        "order_key * 10 + line as line, concat('D', cast(order_key as string), '-', doc_id) as doc_id, is_body, part "
        "from {fx_archive}"
    ),
}

#: fixtures whose first table is spread over all cores before the text work
SPREAD = {"fx_mail": "orders", "fx_index": "orders", "fx_pii": "orders", "fx_body": "orders", "fx_documents": "documents",
          "fx_plain": "documents"}

#: fixtures that other fixtures read, computed once and written
SHARED = frozenset({"fx_words"})

_BASE = frozenset(
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations".split()
)


def _expand(text: str, dialect: str) -> str:
    def macro(match: re.Match) -> str:
        return _MACROS[match[1]][dialect].format(match[2])

    return re.sub(r"\$(\w+)\((.*?)\)\$", macro, text)


def inputs(text: str) -> list[str]:
    """Names in single braces."""
    return list(dict.fromkeys(re.findall(r"(?<!\{)\{([a-z]\w*)\}(?!\})", text)))


def fixture_sql(name: str, dialect: str) -> str:
    """SQL of one fixture with its names still in braces."""
    return _expand(FIXTURES[name], dialect)


def duckdb_sql(select: str) -> str:
    """A self-contained DuckDB statement for a select over tables and fixtures."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in inputs(text):
            if name not in _BASE and name not in ordered:
                visit(FIXTURES[name])
                ordered.append(name)

    visit(select)

    def plain(text: str) -> str:
        text = re.sub(r"(?<!\{)\{([a-z]\w*)\}(?!\})", r"\1", text)
        return text.replace("{{", "{").replace("}}", "}")

    parts = [f"{name} as ({plain(fixture_sql(name, 'duckdb'))})" for name in ordered]
    body = plain(_expand(select, "duckdb"))
    if not parts:
        return body
    return "with " + ", ".join(parts) + " " + body
