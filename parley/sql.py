"""SQL (DuckDB) for the core queries that SQL can express, by the name of the query."""

from .operators.fiscal import USDINR

# What a reader takes for the same, told once more and apart from the tables of the operators.
_TWINS = (
    "АA ВB ЕE КK МM НH ОO РP СC ТT УY ХX ІI ЈJ ЅS аa еe оo рp сc уy хx іi јj ѕs һh ԁd ԛq ԝw ӏl ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX οo αa νv ιi ρp υu "
    "ѐè ЀÈ ёë ЁË їï ЇÏ όó Όó άá ίí ύú ΆÁ ΈÉ ΊÍ ɑa ɡg"
).split()


def look(column: str) -> str:
    """A column with one spelling for all characters that look the same."""
    x = column
    for joined, letters in (("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl")):
        x = f"replace({x}, '{joined}', '{letters}')"
    x = rf"regexp_replace({x}, '[\p{{Cf}}\x{{034F}}\x{{FE00}}-\x{{FE0F}}]', '', 'g')"
    x = rf"regexp_replace(regexp_replace({x}, '\p{{Zs}}', ' ', 'g'), '[‐‑﹣－]', '-', 'g')"
    wide, narrow = (f"(select string_agg(chr((i - {less})::int), '' order by i) from range(65281, 65375) t(i))" for less in (0, 65248))
    return f"nfc_normalize(translate(translate({x}, {wide}, {narrow}), '{''.join(t[0] for t in _TWINS)}', '{''.join(t[1] for t in _TWINS)}'))"


_TL = r"""
    tl as (
        select guidance_id, timeline, extracted_at::date as day, quarter,
            trim(regexp_replace(coalesce(timeline, ''), '\b(H[12]|Q[1-4])\s*', '', 'gi')) as plain
        from guidance_items
    ), tr as (
        select *, try_cast(nullif(regexp_extract(plain, 'FY\s*(\d{2,4})\s*[-–]\s*(?:FY\s*)?(\d{2,4})', 1, 'i'), '') as int) as a0,
            try_cast(nullif(regexp_extract(plain, 'FY\s*(\d{2,4})\s*[-–]\s*(?:FY\s*)?(\d{2,4})', 2, 'i'), '') as int) as b0,
            try_cast(nullif(regexp_extract(plain, '(\d{2,4})$', 1), '') as int) as c0
        from tl
    ), ts as (
        select *, case when a0 > 100 then a0 else a0 + 2000 end as a, case when b0 > 100 then b0 else b0 + 2000 end as b, case when c0 > 100 then c0 else c0 + 2000 end as c,
            case when contains(upper(coalesce(timeline, '')), 'H1') then 0.5 when contains(upper(coalesce(timeline, '')), 'H2') then 0 when contains(upper(coalesce(timeline, '')), 'Q1') then 0.75
                when contains(upper(coalesce(timeline, '')), 'Q2') then 0.5 when contains(upper(coalesce(timeline, '')), 'Q3') then 0.25 else 0 end::double as part_offset
        from tr
    ), span as (
        select *, case when a is not null then least(a, b) else c end as fy_lo, case when a is not null then greatest(a, b) else c end as fy_hi from ts
    )
"""

_SERIES = r"""
    series0 as (
        select o_custkey as company, year(o_orderdate::date + interval 9 month)::int as fy,
            round(sum((l_extendedprice * (1 - l_discount))::decimal(18, 4)), 2)::double as sales,
            round(sum((l_extendedprice * (1 - l_discount) * (l_tax - 0.03))::decimal(18, 4)), 2)::double as net_profit
        from lineitem join orders on l_orderkey = o_orderkey group by all
    )
"""

_BASE = lambda base: rf"""
    base0 as (
        select company, max(sales) filter (fy = {base}) as revenue, max(net_profit) filter (fy = {base}) as pat, max(sales) filter (fy = {base - 3}) as prior_revenue,
            max(net_profit) filter (fy = {base - 3}) as prior_pat
        from series0 group by company
    ), base as (
        select *, round(pat / nullif(revenue, 0) * 100, 2) as net_margin, case when prior_pat is null or pat is null then 'missing' when prior_pat <= 0 then 'base_pat_nonpositive' else 'ok' end as status,
            case when prior_revenue > 0 and revenue > 0 then round((pow(revenue / prior_revenue, 1.0 / 3) - 1) * 100, 1) end as revenue_cagr,
            case when prior_pat > 0 and pat > 0 then round((pow(pat / prior_pat, 1.0 / 3) - 1) * 100, 1) end as pat_cagr0
        from base0
    )
"""  # noqa: E731

_ITEMS = r"""
    it as (
        select scrip as company, guidance_id as ord, metric, guidance_value as value, guidance_unit as unit, currency, timeline, level, page_number as page from guidance_items
    ), it1 as (
        select *, trim(regexp_replace(coalesce(timeline, ''), '\b(H[12]|Q[1-4])\s*', '', 'gi')) as plain from it where level = 'company'
    ), it2 as (
        select *, try_cast(nullif(regexp_extract(plain, 'FY\s*(\d{2,4})\s*[-–]\s*(?:FY\s*)?(\d{2,4})', 1, 'i'), '') as int) as a0,
            try_cast(nullif(regexp_extract(plain, 'FY\s*(\d{2,4})\s*[-–]\s*(?:FY\s*)?(\d{2,4})', 2, 'i'), '') as int) as b0,
            try_cast(nullif(regexp_extract(plain, '(\d{2,4})$', 1), '') as int) as c0,
            case when contains(upper(coalesce(timeline, '')), 'H1') then 0.5 when contains(upper(coalesce(timeline, '')), 'H2') then 0 when contains(upper(coalesce(timeline, '')), 'Q1') then 0.75
                when contains(upper(coalesce(timeline, '')), 'Q2') then 0.5 when contains(upper(coalesce(timeline, '')), 'Q3') then 0.25 else 0 end::double as off
        from it1
    ), it3 as (
        select *, case when a0 is not null then least(case when a0 > 100 then a0 else a0 + 2000 end, case when b0 > 100 then b0 else b0 + 2000 end) else case when c0 > 100 then c0 else c0 + 2000 end end as fy_lo,
            case when a0 is not null then greatest(case when a0 > 100 then a0 else a0 + 2000 end, case when b0 > 100 then b0 else b0 + 2000 end) else case when c0 > 100 then c0 else c0 + 2000 end end as fy_hi
        from it2
    ), it4 as (
        select *, case when fy_hi - 2026 >= 2 then 'long' else 'near' end as block,
            case when metric in ('pat_absolute', 'pat_growth_pct') then 'pat' when metric in ('revenue_absolute', 'revenue_growth_pct') then 'revenue' when metric in ('ebitda_margin_pct', 'pbt_margin_pct') then 'margin' end as class,
            metric in ('pat_absolute', 'revenue_absolute', 'ebitda_margin_pct') as pref,
            coalesce(timeline <> '', false) and not coalesce(regexp_matches(timeline, '\b(H[12]|Q[1-4])\b', 'i'), false) as whole
        from it3
    )
"""


def _drivers(multiples: bool, by_page: bool) -> str:
    clean = "replace(replace(trim(value), ',', ''), '–', '-')"
    if multiples:
        clean = f"replace({clean}, 'x', '')"
    number = r"\d+(?:\.\d+)?"
    page = "coalesce(page, 0) desc," if by_page else ""
    return rf"""
    dr0 as (
        select *, {clean} as v from it4 where class is not null qualify row_number() over (partition by company, block, class, metric, value, timeline order by ord) = 1
    ), dr1 as (
        select *, try_cast(nullif(regexp_extract(v, '^({number})(?:\s*-\s*({number}))?$', 1), '') as double) as lo, try_cast(nullif(regexp_extract(v, '^({number})(?:\s*-\s*({number}))?$', 2), '') as double) as hi0 from dr0
    ), dr2 as (
        select *, coalesce(hi0, lo) as hi from dr1
    ), dr as (
        select *, row_number() over (partition by company, block, class order by pref desc, whole desc, coalesce(hi, lo, -1) desc, {page} ord)::int as rank from dr2
    )"""


_FUND = rf"""
    {_SERIES}, {_BASE(2000)}, fund as (
        select m.scrip as company, round(m.bse_mcap_cr / 100, 2) as forward_pe, revenue as current_revenue, pat as current_pat, net_margin, 19.0::double as ebitda_margin, round(pat * 1.3 / nullif(revenue, 0) * 100, 2) as pbt_margin,
            status, case when status = 'ok' then pat_cagr0 end as pat_cagr
        from company_master m join base on m.scrip::bigint % 100 + 1 = base.company
    )"""


def _growth(convert: bool) -> str:
    unit0 = "replace(replace(rtrim(trim(lower(coalesce(unit, ''))), '.'), 'mn', 'million'), 'bn', 'billion')"
    usd = "upper(coalesce(currency, '')) = 'USD'"

    def money(v: str) -> str:
        if not convert:
            return v
        return f"""case when {unit0} in ('crore', 'crores', 'crs', 'cr') then {v} * case when {usd} then 85.125 * 1 else 1 end when {unit0} in ('lakh', 'lakhs') then {v} * case when {usd} then 85.125 * 0.01::double else 0.01::double end
            when {unit0} in ('million', 'millions') then {v} * case when {usd} then 85.125 * 0.1::double else 0.1::double end when {unit0} in ('billion', 'billions') then {v} * case when {usd} then 85.125 * 100 else 100 end
            when {unit0} in ('', '%', 'times') then {v} end"""

    times = "lower(trim(coalesce(unit, ''))) in ('times', 'x', 'multiple', 'fold')" if convert else "lower(trim(coalesce(unit, ''))) = 'times'"
    every = "" if convert else "and rank = 1"
    base = "and current_pat > 0 and current_revenue <> 0" if convert else ""
    sane = "where not (metric = 'revenue_absolute' and (rev_lo is null or pow(rev_lo / current_revenue, 1 / yb) - 1 > 1))" if convert else ""
    return rf"""
    mg as (select company as mc, block as mb, metric as margin_metric, hi as margin_hi from dr where class = 'margin' and rank = 1),
    c0 as (
        select dr.*, mg.*, f.current_revenue, f.current_pat, f.net_margin, f.ebitda_margin, f.pbt_margin,
            greatest((fy_hi - 2026)::double - off, 0.25) as yb, greatest((fy_lo - 2026)::double - off, 0.25) as yu, coalesce(nullif(hi, 0), lo) as hi2
        from dr join fund f using (company) left join mg on dr.company = mc and dr.block = mb
        where (class = 'pat' and rank = 1 or class = 'revenue' {every}) and current_pat is not null and current_revenue is not null and net_margin is not null and lo is not null and fy_lo is not null {base}
    ), c1 as (
        select *, nullif(net_margin, 0) as net, nullif(case when margin_metric = 'ebitda_margin_pct' then ebitda_margin when margin_metric = 'pbt_margin_pct' then pbt_margin end, 0) as mbase,
            case when metric = 'revenue_absolute' then {money('lo')} when {times} then current_revenue * lo else current_revenue * pow(1 + lo / 100, yb) end as rev_lo,
            case when metric = 'revenue_absolute' then {money('hi2')} when {times} then current_revenue * hi2 else current_revenue * pow(1 + hi2 / 100, yu) end as rev_hi
        from c0
    ), c2 as (
        select *, case when margin_hi is not null then coalesce(case when mbase is not null then greatest(net * margin_hi / mbase, net) end, net) / 100 end as guided from c1
    ), c3 as (
        select *, case when metric = 'pat_absolute' then {money('lo')} when metric = 'pat_growth_pct' then current_pat * pow(1 + lo / 100, yb) else rev_lo * (net_margin / 100) end as f_lo,
            case when metric = 'pat_absolute' then {money('hi2')} when metric = 'pat_growth_pct' then current_pat * pow(1 + hi2 / 100, yu) else rev_hi * greatest(coalesce(guided, net_margin / 100), net_margin / 100) end as f_hi
        from c2 {sane}
    ), c4 as (
        select *, case when f_lo > 0 and current_pat > 0 and yb > 0 then round((pow(f_lo / current_pat, 1.0 / yb) - 1) * 100, 1) end as base, case when f_hi > 0 and current_pat > 0 and yu > 0 then round((pow(f_hi / current_pat, 1.0 / yu) - 1) * 100, 1) end as bull from c3
    ), growth as (
        select company, block, base, bull, trim(replace(metric || ' = ' || coalesce(nullif(value, ''), '—') || ' ' || coalesce(nullif(unit, ''), '') || ' ' || coalesce(nullif(currency, ''), '') || ' | ' || coalesce(nullif(timeline, ''), '—'), '  ', ' ')) as basis
        from c4 where base is not null qualify row_number() over (partition by company, block order by case when class = 'pat' then 0 else rank end, ord) = 1
    )"""


_BLOCKS = "blocks as (select company, max(base) filter (block = 'near') as near_base, max(bull) filter (block = 'near') as near_bull, max(base) filter (block = 'long') as long_base, max(bull) filter (block = 'long') as long_bull from growth group by company)"

_NUM = r"\d+(?:\.\d+)?"
_CLEAN = r"trim(rtrim(regexp_replace(trim(regexp_replace(v, '^[~<>≈≤≥]+\s*|^(approximately|around|about|circa|nearly|roughly)\s+', '', 'i')), '\s+to\s+', '-', 'gi'), '%'))"
_KEY0 = "replace(replace(trim(guidance_value), ',', ''), '–', '-')"
_KEY = f"""case when list_bool_and(list_transform(string_split({_KEY0}, '-'), lambda p: try_cast(trim(p) as decimal(38, 10)) is not null)) then
    array_to_string(list_transform(list_sort(list_transform(string_split({_KEY0}, '-'), lambda p: round(try_cast(trim(p) as decimal(38, 10)), 1)::decimal(36, 1))), lambda n: n::varchar), '-') else lower({_KEY0}) end"""

_MARKERS = (
    r"earnings\s*(?:call|meet|conference)|conference\s*call|con\s*call|concall|analyst\s*(?:call|meet)|investor\s*(?:call|conference|meet)|"
    r"ladies\s+and\s+gentlemen|\bmoderator\b|\bq&a\b|question[\s-]and[\s-]answer|question\s+session|floor\s+is\s+now\s+open|(?:first|next)\s+question"
)
_STATUTORY = (
    r"notice\s+is\s+hereby\s+given|annual\s+general\s+meeting|\b(?:board''?s?|directors?''?)\s+report|independent\s+auditor|balance\s+sheet\s+as\s+at|"
    r"statement\s+of\s+profit\s+and\s+loss|notes\s+to\s+the\s+(?:standalone\s+|consolidated\s+)?financial\s+statements|cash\s+flow\s+statement|corporate\s+governance\s+report"
)
_TEMPORAL = (
    "first half|second half|first quarter|second quarter|third quarter|fourth quarter|h1 |h2 |q1 |q2 |q3 |q4 |this financial year|this fiscal year|this fiscal|next financial year|next fiscal year|next year|coming year|current year|"
    "by end of|by the end of|year-end|year end|coming quarter|upcoming quarter|going forward|full year|annual|next quarter|next few quarters|january|february|march|april|may|june|july|august|september|october|november|december"
)
_COMMIT = "commission|go live|goes live|went live|operationalize|operational|commence operations|commencement|breakeven|break even|break-even|stabilize|ramp up|ramping up|complete|completion|launch"
_PASSES = f"(not coalesce(role = 'moderator', false)) and (regexp_matches(coalesce(text, ''), '\\d') or regexp_matches(lower(coalesce(text, '')), '{_TEMPORAL}') or regexp_matches(lower(coalesce(text, '')), '{_COMMIT}'))"

_VERDICT = rf"""
    dv as (select doc_id, ceil(n_chars / 1800)::int as pages, lower(text) as t, n_chars from documents),
    dw as (
        select *, case when pages >= 3 and length(trim(t)) < 400 then 'NEEDS_OCR' when pages > 70 then 'NOTTRANSCRIPT' when regexp_matches(t, 'ladies\s+and\s+gentlemen|\bmoderator\b|the\s+operator|floor\s+is\s+now\s+open')
            or len(list_distinct(regexp_extract_all(t, '{_MARKERS}'))) >= 2 then 'OK' when regexp_matches(t, '{_STATUTORY}') then 'NOTTRANSCRIPT'
            when len(list_distinct(regexp_extract_all(t, '{_MARKERS}'))) >= 1 and length(trim(t)) / greatest(least(pages, 6), 1) > 1500 then 'OK' else 'NOTTRANSCRIPT' end as verdict from dv
    ), dx as (
        select *, case when coalesce(n_chars, 0) = 0 then 'MISSING' when doc_id % 11 = 0 then 'BADPDF' when coalesce(pages, -1) < 0 then 'BADPDF' when pages < 5 then 'COVER?' else verdict end as file_verdict from dw
    )"""

_NORMAL = r"""
    n0 as (
        select ID, DAY as day, trim(RAW) as s, lower(trim(RAW)) as low, case when month(DAY) >= 4 then year(DAY) % 100 + 1 else year(DAY) % 100 end::int as fy, quarter(DAY - interval 3 month)::int as q from SRC
    ), n1 as (
        select *, coalesce(try_cast(nullif(regexp_extract(low, '\bfy\s*(\d{2,4})\b', 1), '') as int) % 100, try_cast(nullif(regexp_extract(s, '\b20\d{2}[/\-](\d{2,4})\b', 1), '') as int) % 100, try_cast(nullif(regexp_extract(s, '\b(20\d{2})\b', 1), '') as int) % 100,
                case when regexp_matches(low, '\b(this|current)\s+(financial|fiscal)\s+year\b|\bthis\s+fiscal\b|\bend\s+of\s+(this|the)\s+(financial|fiscal)\s+year\b') then fy end,
                case when regexp_matches(low, '\bnext\s+(financial|fiscal)\s+year\b|\bnext\s+year\b|\bcoming\s+year\b') then fy + 1 end) as y2,
            case when regexp_matches(low, '\bq[1-4]\b') then 'Q' || regexp_extract(low, '\bq([1-4])\b', 1) when regexp_matches(low, '\b(first|1st)\s+quarter\b') then 'Q1' when regexp_matches(low, '\b(second|2nd)\s+quarter\b') then 'Q2'
                when regexp_matches(low, '\b(third|3rd)\s+quarter\b') then 'Q3' when regexp_matches(low, '\b(fourth|4th)\s+quarter\b') then 'Q4' when regexp_matches(low, '\bh1(?:\b|fy)|\bfirst\s+half\b') then 'H1' when regexp_matches(low, '\bh2(?:\b|fy)|\bsecond\s+half\b') then 'H2' end as part
        from n0
    ), n2 as (
        select *, case when part[1] = 'H' then part[2]::int * 2 else part[2]::int end as last_q from n1
    ), n3 as (
        select *, case when s = '' then s when regexp_matches(low, '\b(next|coming|upcoming)\s+quarter\b') then 'Q' || (q % 4 + 1) || ' FY' || lpad((case when q % 4 + 1 > q then fy else fy + 1 end)::varchar, 2, '0')
            when regexp_matches(low, '\b(this|current)\s+quarter\b') then 'Q' || q || ' FY' || lpad(fy::varchar, 2, '0') when y2 is not null then coalesce(part || ' ', '') || 'FY' || lpad(y2::varchar, 2, '0')
            when part is not null then part || ' FY' || lpad((case when last_q >= q then fy else fy + 1 end)::varchar, 2, '0') else s end as normal
        from n2
    ), n4 as (
        select *, try_cast(nullif(regexp_extract(normal, '^(?:[HQ][1-4] )?FY(\d{2})$', 1), '') as int) + 2000 as ey, regexp_extract(normal, '^([HQ][1-4]) FY\d{2}$', 1) as ep from n3
    ), n5 as (
        select *, case when ep in ('H3', 'H4') then null when ep = 'Q1' then make_date(ey - 1, 6, 30) when ep in ('Q2', 'H1') then make_date(ey - 1, 9, 30) when ep = 'Q3' then make_date(ey - 1, 12, 31) else make_date(ey, 3, 31) end as ends from n4
    )"""


def _normal(id_: str, day: str, raw: str, src: str) -> str:
    return _NORMAL.replace("ID,", f"{id_} as id,").replace("DAY", day).replace("RAW", raw).replace("SRC", src)


_CHECKED = rf"""
    calls as (select call_id, min(call_date) as call_date from filings group by call_id),
    once as (select call_id, chunk_id, arg_min(struct_pack(s := char_start, t := text), chunk_key) as c from chunks group by all),
    said as (select call_id, string_agg(c.t, chr(10) order by c.s nulls first, chunk_id) as transcript from once group by call_id),
    src as (
        select g.guidance_id as ord, g.call_id as doc, g.metric, g.guidance_value as value, g.guidance_unit as unit, g.timeline, g.passage, g.page_number as page, c.call_date, s.transcript, trim(g.guidance_value) as v
        from guidance_items g join calls c using (call_id) left join said s using (call_id)
    ), {_normal('ord', 'call_date', 'timeline', 'src')}, ck0 as (
        select src.*, n5.normal, n5.ends, case when month(call_date) in (1, 2, 3) then make_date(year(call_date), 1, 1) when month(call_date) < 7 then make_date(year(call_date), 4, 1) when month(call_date) < 10 then make_date(year(call_date), 7, 1) else make_date(year(call_date), 10, 1) end as start,
            case when regexp_matches(v, '^{_NUM}(?:-{_NUM})?$') then v when regexp_matches({_CLEAN}, '^{_NUM}(?:-{_NUM})?$') then {_CLEAN} end as cleaned
        from src join n5 on src.ord = n5.id
    ), ck as (
        select *, case when metric <> 'commissioning_event' and value is null then 'rule1' when value is not null and cleaned is null then 'rule2' when ends < start then 'rule3' end as rule, case when metric <> 'commissioning_event' then cleaned end as clean_value,
            case when trim(coalesce(transcript, '')) <> '' then contains(trim(regexp_replace(transcript, '\s+', ' ', 'g')), trim(regexp_replace(passage, '\s+', ' ', 'g'))) end as found_verbatim
        from ck0
    )"""

_QUOTES = "‘’“”–—' || chr(160), '''''\"\"-- "  # inside a quoted text of SQL
_SQUEEZED = lambda c: rf"regexp_replace(lower(replace(translate({c}, '{_QUOTES}'), '…', '...')), '\s+', '', 'g')"
_HELD = rf"""
    with p as (
        select item_id as ord, call_id, list_filter(list_transform(list_filter(list_transform(string_split_regex(passage, '(?:^|\n)\s*[A-Z][A-Za-z.]*(?: [A-Z][A-Za-z.]*){{0,3}}\s*:\s*'), lambda x: trim(x)), lambda x: x <> ''),
            lambda x: {_SQUEEZED(r"regexp_replace(x, '^[…\s]+', '')")}), lambda x: x <> '') as parts from raw_items
    ), c as (select call_id, chunk_key as chunk_no, {_SQUEEZED('text')} as t from chunks),
    held as (
        select ord, chunk_no, coalesce(len(parts) > 0 and list_bool_and(list_transform(parts, lambda x: contains(t, x))), false) as whole, coalesce(len(parts) > 0 and list_bool_and(list_transform(parts, lambda x: contains(t, x[1:80]))), false) as near
        from p left join c using (call_id)
    )
"""

_EVAL = rf"""
    ev as (
        select call_id as doc, guidance_id as ord, metric, coalesce(timeline, '') as timeline, replace(trim(guidance_value), '–', '-') as v, horizon, level, track, credibility_scorable from guidance_items where call_id is not null
    ), em as (
        select *, coalesce((try_cast(nullif(regexp_extract(v, '^({_NUM})\s*-\s*({_NUM})$', 1), '') as double) + try_cast(nullif(regexp_extract(v, '^({_NUM})\s*-\s*({_NUM})$', 2), '') as double)) / 2, case when regexp_matches(v, '^[+-]?(\d+\.?\d*|\.\d+)$') then try_cast(v as double) end) as mid from ev
    )"""

_GREEDY = rf"""
    {_EVAL}, ca as (
        select r.doc, r.metric, r.timeline, r.ord as ref_ord, list(f.ord order by f.ord) as fs from em r join em f on r.doc = f.doc and r.metric is not distinct from f.metric and r.timeline = f.timeline and r.ord % 2 = 0 and f.ord % 2 = 1
        where r.mid is null and f.mid is null or r.mid = 0 and f.mid = 0 or r.mid <> 0 and abs(r.mid - f.mid) / r.mid <= 0.10 group by all
    ), cn as (select *, row_number() over (partition by doc, metric, timeline order by ref_ord) as k from ca),
    gr as (
        select doc, metric, timeline, 0::bigint as k, []::bigint[] as used, null::bigint as ref_ord, null::bigint as found_ord from (select distinct doc, metric, timeline from cn)
        union all
        select doc, metric, timeline, k, case when f is null then used else list_append(used, f) end, ref_ord, f
        from (select n.doc, n.metric, n.timeline, n.k, g.used, n.ref_ord, list_filter(n.fs, lambda x: not list_contains(g.used, x))[1] as f from gr g join cn n on g.doc = n.doc and g.metric is not distinct from n.metric and g.timeline = n.timeline and n.k = g.k + 1)
    ), gp as (select doc, ref_ord, found_ord from gr where found_ord is not null)
"""

_PAGES = r"""
    lis as (
        select scrip, string_agg('<li class="flex flex-gap-8 x"><div> ' || strftime(call_date, '%b %Y') || ' </div>' || case when attachment is not null then '<a href="https://files.invalid/' || attachment || '"> Transcript </a>' else '<div>Transcript</div>' end || '</li>', '' order by filing_id) as lis
        from filings where scrip is not null and call_date is not null group by scrip
    )"""

_ORDERED_CALLS = r"""
    cl as (
        select scrip as key, (row_number() over (partition by scrip order by filing_id) - 1)::int as ord, strftime(call_date, '%Y-%m') as date, (case when month(call_date) >= 7 then year(call_date) + 1 else year(call_date) end)::int as fy,
            case when month(call_date) between 4 and 6 then 'Q4' when month(call_date) between 7 and 9 then 'Q1' when month(call_date) >= 10 then 'Q2' else 'Q3' end as quarter, 'https://files.invalid/' || attachment as transcript_url
        from filings where scrip in (select scrip from company_master) and call_date is not null
    )"""

_TURNS = r"""
    tt as (
        select call_id as doc, char_start as turn_no, arg_min(struct_pack(s := coalesce(speaker, ''), r := role, t := text), turn_id) as x from turns where call_id is not null and char_start is not null and text is not null group by all
    ), tu as (
        select doc, turn_no, x.s as speaker, x.t as text, case when lower(trim(x.r)) in ('analyst', 'investor', 'participant') then 'analyst' when lower(trim(x.r)) in ('moderator', 'operator', 'host') then 'moderator' else 'management' end as role from tt
    ), tv as (
        select *, case when role = 'analyst' then speaker end as a, last_value(case when role = 'analyst' then speaker end ignore nulls) over (partition by doc order by turn_no rows between unbounded preceding and 1 preceding) as before from tu
    ), tw as (
        select *, sum((a is not null and a is distinct from before)::int) over (partition by doc order by turn_no rows between unbounded preceding and current row)::bigint as no from tv
    ), tx as (
        select *, case when role = 'moderator' then coalesce(first_value(case when role <> 'moderator' then no end ignore nulls) over (partition by doc order by turn_no rows between 1 following and unbounded following), no) else no end as number from tw
    )"""

_RATES = ", ".join(map(str, USDINR))
_WORDS = "['one', 'two', 'three', 'four', 'five', 'six', 'seven', 'eight', 'nine', 'ten']"
_IMPLIED = rf"""
    g0 as (
        select *, lower(trim(coalesce(metric, 'none'))) as m, lower(trim(coalesce(guidance_unit, ''))) as u, list_filter(string_split(replace(replace(replace(trim(guidance_value), ',', ''), '–', '-'), 'x', ''), '-'), lambda p: trim(p) <> '') as parts, replace(lower(timeline), '–', '-') as t from guidance_items
    ), g1 as (
        select *, list_transform(parts, lambda p: case when regexp_matches(trim(p), '^[+]?(\d+\.?\d*|\.\d+)$') then try_cast(trim(p) as double) end) as nums,
            list_transform(regexp_extract_all(t, 'fy\s*''?(\d{{2}})\b', 1), lambda y: greatest((y::int - 24)::double, 0.5)) || list_transform(regexp_extract_all(t, '\b(20\d{{2}})\b', 1), lambda y: greatest((y::int % 100 - 24)::double, 0.5)) as ahead,
            list_transform(regexp_extract_all(t, '\b(\d+(?:\.\d+)?)\s*(?:year|yr)', 1), lambda y: y::double) as digits, list_transform(regexp_extract_all(t, '\b(one|two|three|four|five|six|seven|eight|nine|ten)\b', 1), lambda w: list_position({_WORDS}, w)::double) as spoken
        from g0
    ), g2 as (
        select *, case when len(ahead) > 0 then ahead when contains(t, 'next year') or contains(t, 'next fiscal') or contains(t, 'coming year') then [1.0::double] when len(digits) > 0 then digits when len(spoken) > 0 and (contains(t, 'year') or contains(t, 'yr')) then spoken else []::double[] end as ys,
            len(parts) > 0 and list_bool_and(list_transform(nums, lambda n: n is not null)) as ok from g1
    ), g3 as (
        select *, case when ok then list_min(nums) end as v_lo, case when ok then list_max(nums) end as v_hi, list_min(ys) as years_lo, list_max(ys) as years_hi, u in ('%', 'percent', 'pct') as percent, u in ('times', 'x', 'multiple', 'fold') as times, u in ('crore', 'cr', 'lakh', 'million', 'mn', 'billion', 'bn') as money,
            replace(replace(u, 'mn', 'million'), 'bn', 'billion') as w, upper(coalesce(currency, '')) = 'USD' as usd from g2
    ), g4 as (
        select *, case when m in ('none', '') then null when v_lo is null then 'value' when percent then null when times and years_lo is null then 'timeframe' when times and (v_lo <= 0 or years_lo <= 0 or years_hi <= 0) then 'non-positive' when times then null
            when money and v_hi * case when w in ('crore', 'cr') then 1 when w = 'lakh' then 0.01 when w = 'million' then case when usd then 8.3 else 0.1 end else case when usd then 8300 else 100 end end > 500000 then 'absurd' when not money then 'unit' end as reason from g3
    ), g5 as (
        select *, case when m in ('none', '') then 'none' when reason is not null then 'unparseable' when percent or times then 'ok' else 'needs_base' end as status, case when percent then v_lo / 100 when times then pow(v_lo, 1.0 / years_hi) - 1 end as low, case when percent then v_hi / 100 when times then pow(v_hi, 1.0 / years_lo) - 1 end as high from g4
    )"""

_NP = lambda x: rf"regexp_replace(replace(string_split({x}, '.')[1], ',', ''), '(\d)', '\1,?', 'g') || case when contains({x}, '.') then '[.]' || string_split({x}, '.')[2] else '' end"
_CUR = r"(us[$]|usd|[$]|₹|rs[.]?|inr)?"
_TAIL = (
    r"\s*(%age|% ?p[.]a[.]|%|per ?cent|pct|bps|bp\b|basis points?|(?:lakh|lac|million|mn|thousand)\s*(?:metric )?(?:tons?|tonnes?|mt)(?:\s*(?:a year|per annum|p[.]a[.]))?|crores?|crs?\b[.]?|lakhs?|lacs?|million|mn|mio|billion|bn|"
    r"(?:metric )?(?:tons?|tonnes?|mt)\b(?:\s*(?:per month|/month|monthly|per annum|/year|p[.]a[.]))?|ktpa|tpa|tpm|kt\b|quintals?|qtl|rupees a kilo|(?:₹|rs|inr)\s*(?:/|per)\s*(?:kg|mt|tonne|ton)|per ton|months?|mths?|quarters?|qtrs?|years?|yrs?|mw\b|megawatt|gw\b|times|x\b)"
)
_P3 = rf"""
    f as (
        select guidance_id, upper(trim(quarter)) as q, replace(lower({look('guidance_value')}), '''000', ' thousand ') as v, replace(lower(trim({look("coalesce(guidance_unit, '')")})), '''000', 'thousand') as u0, upper(trim(coalesce(currency, ''))) as c0,
            replace(lower({look("coalesce(passage, '')")}), '''000', ' thousand ') as p from guidance_items where guidance_value is not null
    ), g as (select *, regexp_extract_all(v, '\d[\d,]*(?:[.]\d+)?') as nums from f),
    h as (select *, case when len(nums) > 1 then 2 else 1 end as k, trim(regexp_replace(regexp_replace(v, '\d[\d,]*(?:[.]\d+)?', ' ', 'g'), '[<>=~+–-]|\b(?:to|up|approx)\b[.]?', ' ', 'g')) as w from g where len(nums) > 0),
    i as (
        select *, case when k = 1 then '(?:^|[^\d.,a-z])' || '{_CUR}' || '\s*' || {_NP('nums[1]')} || '{_TAIL}'
            else '(?:^|[^\d.,a-z])' || '{_CUR}' || '\s*' || {_NP('nums[1]')} || '[^\d]{{0,20}}?(?:-|–|\bto\b)[^\d]{{0,8}}' || {_NP('nums[2]')} || '{_TAIL}' end as rx from h
    ), j as (select *, regexp_extract(p, rx, 1) as pc, regexp_extract(p, rx, 2) as pu from i),
    k as (select *, case when w <> '' then w when u0 not in ('', 'n/a', '-') then u0 else pc || ' ' || pu end as t from j),
    l as (
        select *, regexp_matches(t, '(?:/|per|\ba)\s*(?:mt|tonne|ton|kg|kilo)\b') as price, regexp_matches(t, '\b(?:tons?|tonnes?|mt|kt|ktpa|tpa|tpm|quintals?|qtl)\b') as mass, regexp_matches(t, 'month|tpm') as monthly, regexp_matches(t, 'annum|year|tpa|p[.]a') as yearly,
            regexp_matches(t, '%|per ?cent|pct') as pct, regexp_matches(t, '\bbps?\b|basis') as bp, regexp_matches(t, '\b(?:crores?|crs?)\b') as cr, regexp_matches(t, '\b(?:lakhs?|lacs?)\b') as lk, regexp_matches(t, '\b(?:million|mn|mio)\b') as mn, regexp_matches(t, '\b(?:billion|bn)\b') as bn,
            regexp_matches(t, '\bthousand\b') as th from k
    ), m as (
        select *, case when pct or bp then 'bps' when price then 'inr_per_tonne' when mass and (monthly or yearly) then 'kg_per_year' when mass then 'kg' when regexp_matches(t, '\b(?:months?|mths?|quarters?|qtrs?|years?|yrs?)\b') then 'months' when regexp_matches(t, '\b(?:mw|gw|megawatt)\b') then 'kw'
                when cr or lk or mn or bn then 'inr' end as common_unit from l
    ), n as (
        select *, case common_unit when 'bps' then case when bp then 1 else 100 end when 'inr_per_tonne' then case when regexp_matches(t, '\b(?:kg|kilo)\b') then 1000 else 1 end
                when 'months' then case when regexp_matches(t, 'month|mth') then 1 when regexp_matches(t, 'quarter|qtr') then 3 else 12 end when 'kw' then case when regexp_matches(t, '\bgw\b') then 1000000 else 1000 end
                when 'inr' then case when cr then 10000000 when lk then 100000 when mn then 1000000 else 1000000000 end
                else case when lk then 100000 when mn then 1000000 when th then 1000 else 1 end * case when regexp_matches(t, '\b(?:kt|ktpa)\b') then 1000000 when regexp_matches(t, 'quintal|qtl') then 100 else 1000 end * case when common_unit = 'kg_per_year' and monthly then 12 else 1 end end::double as factor,
            case when common_unit <> 'inr' or cr or lk then 'INR' when regexp_matches(t, 'usd|[$]') then 'USD' when regexp_matches(t, 'inr|rs|₹') then 'INR' when c0 in ('USD', 'US$', '$') then 'USD' when c0 <> '' then 'INR' when regexp_matches(pc, 'usd|[$]') then 'USD' else 'INR' end as cur from m where common_unit is not null
    ), o as (select n.*, case when cur = 'INR' then 1 else x.inr_per_unit end::double as fx, replace(nums[1], ',', '')::decimal(14, 4)::double as n1, replace(nums[k], ',', '')::decimal(14, 4)::double as n2 from n left join fx_rates x on x.currency = cur and upper(trim(x.quarter)) = q)
"""

SQL: dict[str, str] = {
    "p3_quantities": rf"with {_P3} select guidance_id, common_unit, round(least(n1, n2) * factor * fx)::bigint as lo, round(greatest(n1, n2) * factor * fx)::bigint as hi, cur as currency from o",
    "p3_found": rf"with {_P3} select guidance_id, common_unit, round(least(n1, n2) * factor * fx)::bigint as lo, round(greatest(n1, n2) * factor * fx)::bigint as hi from o",
    "fiscal_fields": rf"""
        with {_TL}, f as (
            select *, try_cast(nullif(regexp_extract(quarter, 'FY\s*(\d{{2,4}})', 1, 'i'), '') as int) as y0, try_cast(nullif(regexp_extract(quarter, 'Q\s*([1-4])\s*FY\s*''?(\d{{2,4}})', 1, 'i'), '') as int) as q0,
                try_cast(nullif(regexp_extract(trim(timeline), '(\d{{2,4}})$', 1), '') as int) as l0,
                list_transform(regexp_extract_all(upper(coalesce(timeline, '')), 'FY\s*(\d{{2,4}})', 1), lambda y: case when y::int > 100 then y::int else y::int + 2000 end)
                || list_transform(regexp_extract_all(regexp_replace(upper(coalesce(timeline, '')), 'FY\s*\d{{2,4}}', ' ', 'g'), '\b(20\d{{2}})\b', 1), lambda y: y::int) as named
            from span
        ), g as (select *, case when y0 > 100 then y0 else y0 + 2000 end as call_fy from f)
        select guidance_id, call_fy, coalesce(case when q0 = 4 then call_fy else case when q0 is not null then call_fy - 1 end end, 2024)::int as base_fy, case when l0 > 100 then l0 else l0 + 2000 end as last_year, fy_lo, fy_hi, part_offset,
            case when fy_hi is not null and call_fy is not null then greatest((fy_hi - call_fy)::double - part_offset, 0.25) end as years, case when fy_hi - call_fy > 2 then 'long' when fy_hi - call_fy = 2 then 'medium' else 'near' end as horizon_derived,
            coalesce(array_to_string(range(list_min(named), list_max(named) + 1), ','), '') as years_spanned
        from g
    """,
    "fiscal_calendar": r"""
        select filing_id, (case when month(call_date) >= 4 then year(call_date) % 100 + 1 else year(call_date) % 100 end)::int as fy2, quarter(call_date - interval 3 month)::int as q, date_trunc('quarter', call_date)::date as q_start,
            case when month(call_date) between 4 and 6 then 'Q4' when month(call_date) between 7 and 9 then 'Q1' when month(call_date) between 10 and 12 then 'Q2' when month(call_date) is not null then 'Q3' end as reported_q,
            (case when month(call_date) >= 7 then year(call_date) + 1 else year(call_date) end)::int as reported_fy from filings
    """,
    "timeline_normal": rf"with {_normal('guidance_id', 'extracted_at::date', 'timeline', 'guidance_items')} select id as guidance_id, normal, ends from n5",
    "title_quarter": r"""
        with t as (select filing_id, lower(concat_ws(' ', name, headline, regexp_replace(call_period, '^(\d)QFY', 'Q\1 FY'))) as t from filings),
        u as (select *, regexp_extract(t, '\bq([1-4])\b\s*(?:&|and)?\s*\bf\.?\s*y\.?[''‘’`´°\-.\s]*(?:\d{2,4}\s*[-/]\s*)?(\d{2,4})\b', 1) as q, regexp_extract(t, '\bq([1-4])\b\s*(?:&|and)?\s*\bf\.?\s*y\.?[''‘’`´°\-.\s]*(?:\d{2,4}\s*[-/]\s*)?(\d{2,4})\b', 2) as y from t)
        select filing_id, case when q <> '' then 'Q' || q end as quarter, case when q <> '' then 'FY' || right(y, 2) end as fy from u
    """,
    "value_fields": rf"""
        with a as (select *, trim(guidance_value) as v, replace(trim(guidance_value), '–', '-') as w, replace(replace(replace(trim(guidance_value), ',', ''), '–', '-'), 'x', '') as z, replace(replace(trim(guidance_value), ',', ''), '–', '-') as u from guidance_items),
        b as (
            select *, try_cast(nullif(regexp_extract(u, '^({_NUM})(?:\s*-\s*({_NUM}))?$', 1), '') as double) as lo, try_cast(nullif(regexp_extract(u, '^({_NUM})(?:\s*-\s*({_NUM}))?$', 2), '') as double) as hi0,
                list_filter(string_split(z, '-'), lambda p: trim(p) <> '') as parts from a
        ), c as (select *, list_transform(parts, lambda p: case when regexp_matches(trim(p), '^[+]?(\d+\.?\d*|\.\d+)$') then try_cast(trim(p) as double) end) as nums from b)
        select guidance_id, lo, coalesce(hi0, lo) as hi,
            coalesce((try_cast(nullif(regexp_extract(w, '^({_NUM})\s*-\s*({_NUM})$', 1), '') as double) + try_cast(nullif(regexp_extract(w, '^({_NUM})\s*-\s*({_NUM})$', 2), '') as double)) / 2, case when regexp_matches(w, '^[+-]?(\d+\.?\d*|\.\d+)$') then try_cast(w as double) end) as mid,
            case when len(parts) > 0 and list_bool_and(list_transform(nums, lambda n: n is not null)) then list_min(nums) end as least, case when len(parts) > 0 and list_bool_and(list_transform(nums, lambda n: n is not null)) then list_max(nums) end as most,
            case when regexp_matches(v, '^{_NUM}(?:-{_NUM})?$') then v when regexp_matches({_CLEAN}, '^{_NUM}(?:-{_NUM})?$') then {_CLEAN} end as clean, {_KEY} as value_key,
            metric in ('revenue_absolute', 'revenue_growth_pct', 'ebitda_margin_pct', 'pat_absolute', 'pat_growth_pct', 'pbt_margin_pct', 'eps_absolute') as credible,
            metric in ('revenue_absolute', 'revenue_growth_pct', 'ebitda_margin_pct', 'pat_absolute', 'pat_growth_pct', 'pbt_margin_pct', 'eps_absolute') and level = 'company' and horizon = 'near' as credible_strict
        from c
    """,
    "passage_forms": r"""
        select guidance_id, trim(regexp_replace(passage, '\s+', ' ', 'g')) as collapsed, upper(trim(regexp_replace(coalesce(timeline, ''), '\s+', ' ', 'g'))) as timeline_key,
            regexp_replace(lower(replace(translate(passage, '‘’“”–—' || chr(160), '''''""-- '), '…', '...')), '\s+', '', 'g') as squeezed, sha256(passage) as sha,
            coalesce(list_bool_or(list_transform(regexp_extract_all(coalesce(timeline, ''), '(\d{2,4})', 1), lambda y: contains(passage, (case when y::int > 100 then y::int else y::int + 2000 end)::varchar)
                or regexp_matches(lower(passage), 'fy\s*''?' || lpad((y::int % 100)::varchar, 2, '0') || '\b') or regexp_matches(passage, '''' || lpad((y::int % 100)::varchar, 2, '0') || '\b'))), false) as year_told,
            trim(replace(metric || ' = ' || coalesce(nullif(guidance_value, ''), '—') || ' ' || coalesce(nullif(guidance_unit, ''), '') || ' ' || coalesce(nullif(currency, ''), '') || ' | ' || coalesce(nullif(timeline, ''), '—'), '  ', ' ')) as label
        from guidance_items
    """,
    "filing_names": r"""
        select filing_id, lower(regexp_replace(regexp_replace(regexp_replace(name, '\b(Ltd|Limited)\b\.?', '', 'gi'), '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')) as slug_of_name,
            case when slug is not null and scrip is not null then nullif(lower(substring(name, 1, 6)), '') end as ticker, case when name is not null and scrip is not null then slug end as url_slug, try_cast(scrip || '000' as double) as number from filings
    """,
    "candidate_chunks": rf"""
        select chunk_key, concat_ws('+', case when regexp_matches(coalesce(text, ''), '\d') then 'digit' end, case when regexp_matches(lower(coalesce(text, '')), '{_TEMPORAL}') then 'temporal' end, case when regexp_matches(lower(coalesce(text, '')), '{_COMMIT}') then 'commitment' end) as reasons
        from chunks where {_PASSES}
    """,
    "filter_pass_rate": rf"select coalesce(chunk_type, 'all') as chunk_type, count(*) as chunks, count_if({_PASSES})::bigint as passed, round(count_if({_PASSES}) / count(*), 6) as share from chunks group by rollup (chunk_type)",
    "document_verdicts": rf"with {_VERDICT} select doc_id, pages, verdict, file_verdict from dx",
    "verdict_tally": rf"with {_VERDICT} select file_verdict, count(*) as documents from dx group by file_verdict",
    "stripped_pages": r"""
        with p as (select doc_id, concat_ws(chr(10), '', 'Asha Works Limited', 'May 5, 2025', text, 'Page 3 of 9', '  ' || doc_id || ' |') as page from documents),
        l as (select doc_id, string_split(page, chr(10)) as lines, list_transform(string_split(page, chr(10)), lambda x: trim(x)) as t from p),
        m as (
            select *, len(t) as n, list_transform(t, lambda x: x <> '' and not (regexp_matches(x, '^(January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2},?\s+\d{4}$', 'i')
                or regexp_matches(x, '^.+\b(Limited|Ltd\.?|Inc\.?|Corp\.?|Pvt\.?)$', 'i') or regexp_matches(x, '^Page\s+\d+\s+of\s+\d+$', 'i'))) as content, len(t) - coalesce(list_position(list_reverse(list_transform(t, lambda x: x <> '')), true), 0) + 1 as final from l
        ), q as (select *, list_transform(content, lambda c, i: c and not (i = final and regexp_matches(t[i], '^\d+\s*\|$|^\|\s*\d+$'))) as below from m),
        r as (select *, coalesce(list_position(content, true), 0) as a, n - coalesce(list_position(list_reverse(below), true), 0) + 1 as b from q)
        select doc_id, case when not list_bool_or(below) or b < a then '' else array_to_string(lines[greatest(a, 1):b], chr(10)) end as stripped from r
    """,
    "speaker_label_parts": r"""
        with c as (select chunk_key, text, regexp_replace(text, '(?:Moderator|Management|Analyst) \(([^)]*)\):', '\1:', 'g') as t from chunks),
        p as (select *, list_filter(list_transform(string_split_regex(t, '(?:^|\n)\s*[A-Z][A-Za-z.]*(?: [A-Z][A-Za-z.]*){0,3}\s*:\s*'), lambda x: trim(x)), lambda x: x <> '') as parts from c)
        select chunk_key, len(parts)::int as n_parts, length(array_to_string(parts, '|'))::int as length, trim(regexp_replace(replace(text, chr(10), ' '), ' {2,}', ' ', 'g')) as flat from p
    """,
    "joined_pages": r"""
        with p as (select doc_id as doc, unnest(string_split(text, chr(10) || chr(10))) as text, generate_subscripts(string_split(text, chr(10) || chr(10)), 1) as page_no from documents),
        q as (select doc, page_no, case when page_no % 7 <> 0 then text end as text from p)
        select doc, coalesce(string_agg('[Page ' || page_no || ']' || chr(10) || text, chr(10) || chr(10) order by page_no) filter (coalesce(text, '') <> ''), '') as text from q group by doc
    """,
    "first_pages": r"""
        with p as (select doc_id as doc, unnest(string_split(text, chr(10) || chr(10))) as text, generate_subscripts(string_split(text, chr(10) || chr(10)), 1) as page_no from documents)
        select doc, lower(string_agg(text, chr(10) order by page_no) filter (page_no <= 2)) as text, max(page_no)::int as pages from p group by doc
    """,
    "roster_members": r"""
        with n as (select call_id, list(distinct name) as names from participants where role = 'management' group by call_id), l as (select distinct call_id, speaker from turns where speaker is not null)
        select call_id, speaker, list_contains(names, speaker) or (not contains(trim(speaker), ' ') and length(trim(speaker)) >= 4 and list_bool_or(list_transform(names, lambda x: lower(string_split(x, ' ')[-1]) = lower(trim(speaker))))) as management from l join n using (call_id)
    """,
    "validation": rf"with {_CHECKED} select ord, rule, clean_value, normal as clean_timeline, found_verbatim from ck",
    "rejection_log": rf"""
        with {_CHECKED} select ord, rule, case rule when 'rule1' then 'null_value_non_binary_metric' when 'rule2' then 'malformed_guidance_value' else 'past_timeline: ' || normal || ' ended ' || ends::varchar || ' before ' || start::varchar end as reason,
            metric || ' | ' || coalesce(value, 'None') || ' ' || coalesce(unit, '') || ' | ' || coalesce(timeline, 'None') || ' | p' || coalesce(page::varchar, 'None') as summary from ck where rule is not null
    """,
    "exact_repeats": rf"""
        with {_CHECKED}, k as (select *, {_KEY.replace('guidance_value', 'clean_value')} as vk from ck where rule is null)
        select ord, row_number() over (partition by doc, metric, vk, normal order by length(coalesce(passage, '')) desc, ord) = 1 as kept, min(ord) over (partition by doc, metric, vk, normal) as group_order from k
    """,
    "cap_cohort": "select scrip, case when bse_mcap_cr is null then 'unresolved' when bse_mcap_cr <= 3000 then 'cohort' else 'over_cap' end as status, bse_mcap_cr as mcap from company_master where bse_mcap_cr is null or bse_mcap_cr <= 5000",
    "cohort_items": "select guidance_id, scrip, ticker, exchanges from guidance_items join company_master using (scrip)",
    "prompt_versions": r"""
        with a as (select scrip, metric, count(*) as n0 from guidance_items where guidance_id % 2 = 0 group by all), b as (select scrip, metric, count(*) as n1 from guidance_items where guidance_id % 2 = 1 group by all)
        select coalesce(a.scrip, b.scrip) as scrip, coalesce(a.metric, b.metric) as metric, n0, n1 from a full join b on a.scrip = b.scrip and a.metric = b.metric
    """,
    "usable_calls": "select filing_id, call_id from filings where call_id in (select call_id from chunks)",
    "missed_filings": r"""
        with known as (select scrip from filings where contains(lower(coalesce(headline, '')), 'transcript') and trim(coalesce(attachment, '')) <> '' and trim(coalesce(scrip, '')) <> '' and scrip::bigint % 3 <> 0),
        f as (select *, lower(concat_ws(' ', regexp_replace(headline, 'transcript', 'document', 'gi'), headline)) as t from filings where attachment is not null and scrip not in (select scrip from known))
        select scrip, news_dt, attachment from f where regexp_matches(t, 'transcript|con\s*call|earnings call|analyst meet') qualify row_number() over (partition by scrip order by news_dt nulls last, attachment) = 1
    """,
    "item_chunks": rf"{_HELD} select ord, min(chunk_no) filter (whole) as chunk_no from held group by ord",
    "item_anchor_chunks": rf"{_HELD} select ord, coalesce(min(chunk_no) filter (whole), min(chunk_no) filter (near)) as chunk_no from held group by ord",
    "chunk_pages": r"""
        with c as (select * from chunks where char_start is not null and page_start is not null), p as (select call_id, page_start as page_no, max(length(text)) as n from c group by all),
        b as (select *, coalesce(sum(n + 1) over (partition by call_id order by page_no rows between unbounded preceding and 1 preceding), 0) as s from p)
        select chunk_key, char_start::bigint as "offset", coalesce((select max(page_no) from b where b.call_id = c.call_id and c.char_start >= s and c.char_start < s + n), (select max(page_no) from b where b.call_id = c.call_id)) as page_no from c
    """,
    "greedy_match": rf"with recursive {_GREEDY} select doc, ref_ord, found_ord from gp",
    "precision_recall": rf"""
        with recursive {_GREEDY}, m as (select doc, count(*) as matched from gp group by doc), n as (select doc, count_if(ord % 2 = 0)::bigint as reference_items, count_if(ord % 2 = 1)::bigint as found_items from em group by doc)
        select doc, reference_items, found_items, coalesce(matched, 0) as matched, coalesce(round(matched / nullif(reference_items, 0), 6), 0) as recall, coalesce(round(matched / nullif(found_items, 0), 6), 0) as precision from n left join m using (doc)
    """,
    "tag_agreement": rf"""
        with recursive {_GREEDY}, p as (select x, y from gp join em x on x.doc = gp.doc and x.ord = ref_ord join em y on y.doc = gp.doc and y.ord = found_ord),
        l as (
            select 'metric' as tag, trim(x.metric) is not distinct from trim(y.metric) as same from p union all select 'horizon', trim(x.horizon) is not distinct from trim(y.horizon) from p union all select 'level', trim(x.level) is not distinct from trim(y.level) from p
            union all select 'track', trim(x.track) is not distinct from trim(y.track) from p union all select 'credibility_scorable', x.credibility_scorable is not distinct from y.credibility_scorable from p)
        select tag, count_if(same)::bigint as agree, count(*) as total from l group by tag
    """,
    "transcript_quarters": r"""
        with f as (select *, case when month(news_dt) between 4 and 6 then 'Q4' when month(news_dt) between 7 and 9 then 'Q1' when month(news_dt) >= 10 then 'Q2' else 'Q3' end as quarter, (case when month(news_dt) >= 7 then year(news_dt) + 1 else year(news_dt) end)::int as fy from filings
            where news_dt is not null and trim(coalesce(attachment, '')) <> '' and trim(coalesce(scrip, '')) <> '' and contains(lower(coalesce(headline, '')), 'transcript'))
        select scrip, quarter, fy, attachment, news_dt from f qualify row_number() over (partition by scrip, quarter, fy order by news_dt, attachment) = 1
    """,
    "call_years": r"""
        with n as (select filing_id, case when filing_id % 3 <> 0 then concat_ws('_', slug, regexp_replace(headline, '\s+', '_', 'g')) end as named, call_period from filings),
        y as (select *, try_cast(nullif(regexp_extract(named, 'FY\s*(\d{2,4})', 1, 'i'), '') as int) as a, try_cast(nullif(regexp_extract(call_period, 'FY\s*(\d{2,4})', 1, 'i'), '') as int) as b from n),
        z as (select *, case when a > 100 then a else a + 2000 end as x, case when b > 100 then b else b + 2000 end as w from y)
        select filing_id, coalesce(x, w, 2026)::int as fy, case when x is not null then 'file' when w is not null then 'header' else 'default' end as source, coalesce(x <> w, false) as mismatch from z
    """,
    "attachment_candidates": r"""
        with f as (select call_id as key, attachment, lower(coalesce(headline, '')) as h, coalesce(length(headline), 0) as size from filings where call_id is not null and attachment is not null),
        g as (select *, contains(h, 'transcript') as says, not (contains(h, 'audio') or contains(h, 'recording')) as written from f),
        o as (select * from g qualify row_number() over (partition by key, attachment order by says desc, written desc, size desc) = 1)
        select key, attachment, row_number() over (partition by key order by says desc, written desc, size desc, attachment)::int as place from o
    """,
    "batch_states": "select doc_id as doc, case when n_chars % 5 = 0 or n_chars is null then 'waiting' when n_chars % 3 <> 0 then 'done' else 'failed' end as state from documents",
    "extracted_items": rf"""
        with c as (select call_id as doc, chunk_key as chunk_no, string_split(regexp_replace(coalesce(text, ''), '([.!?])\s+([A-Z])', '\1' || chr(1) || '\2', 'g'), chr(1)) as parts from chunks where {_PASSES}),
        s as (select doc, chunk_no, unnest(parts) as s, generate_subscripts(parts, 1) as i from c),
        a as (select *, '(\d[\d,]*(?:\.\d+)?(?:\s*(?:-|to)\s*\d[\d,]*(?:\.\d+)?)?)\s*(%|bps|basis points|crore|lakh|million|billion|times|MW|tons?|tonnes?)' as rx from s),
        b as (
            select *, regexp_extract(s, rx, 1, 'i') as v, regexp_extract(s, rx, 2, 'i') as u, regexp_replace(s, '^\s+|\s+$', '', 'g') as passage, regexp_extract(s, '\b((?:[HQ][1-4] )?FY\d{{2}}(?:\s*-\s*FY?\d{{2}})?|next year|this fiscal year|the coming quarter)\b', 1, 'i') as timeline
            from a where regexp_matches(s, rx, 'i') and regexp_matches(s, '\b(?:will|should|expect\w*|target\w*|guid\w+|plan\w*|aim\w*|likely|by FY\d{{2}}|in FY\d{{2}})\b', 'i')
        )
        select doc, chunk_no, 0 as run_index, (row_number() over (partition by doc, chunk_no order by i) - 1)::int as ord, passage, substring(passage, 1, 80) as metric_description, regexp_replace(v, '\s*to\s*', '-', 'g') as guidance_value, u as guidance_unit, timeline from b
    """,
    "proposals": r"""
        with g as (select *, min(company) over (partition by call_id) as c, row_number() over (partition by call_id order by guidance_id) - 1 as n from guidance_items where call_id is not null)
        select call_id::varchar as doc, c as company, n::int as place, guidance_id::int as candidate_id, passage, metric, guidance_value, timeline, credibility_scorable, guidance_unit is null as uncertain from g
    """,
    "top_returns": rf"""
        with {_SERIES}, s as (select company, max(round(sales, 2)) filter (fy = 1996) as sales, max(round(sales, 2)) filter (fy = 1997) as nxt from series0 group by company), k as (select sales as s, nxt / nullif(sales, 0) as o from s where sales is not null and nxt / nullif(sales, 0) is not null),
        f as (select quantile_cont(s, 0.95) as border, quantile_cont(o, 0.5) as median, count(*) as companies from k)
        select companies, count(*) as top, round(avg(o), 6) as top_mean, round(median, 6) as median, round(avg((o > median)::int), 6) as hit_rate from k, f where s >= border group by companies, median
    """,
    "passage_divergence": r"""
        with once as (select call_id, chunk_id, arg_min(text, chunk_key) as text from chunks group by all),
        j as (select item_id, list_filter(string_split_regex(coalesce(passage, ''), '\s+'), lambda w: w <> '') as a, list_filter(string_split_regex(coalesce(text, ''), '\s+'), lambda w: w <> '') as b from raw_items left join once using (call_id, chunk_id)),
        k as (select *, list_transform(a, lambda w: lower(replace(translate(w, '‘’“”–—', '''''""--'), '…', '...'))) as ka, list_transform(b, lambda w: lower(replace(translate(w, '‘’“”–—', '''''""--'), '…', '...'))) as kb from j),
        s as (select *, case when len(ka) > 0 then list_filter(range(1, len(kb) + 1), lambda i: kb[i] = ka[1] and kb[i:i + least(len(ka), 5) - 1] = ka[1:5])[1] end as start from k),
        d as (select *, case when start is null then -1 else coalesce(list_filter(range(0, len(ka)), lambda i: start + i > len(kb) or kb[start + i] <> ka[i + 1])[1], len(ka)) end::int as n from s)
        select item_id, n as "at", array_to_string(case when n < 0 then a[1:15] else a[n + 1:n + 15] end, ' ') as expected, case when n < 0 then '' else array_to_string(b[start + n:start + n + 14], ' ') end as found from d
    """,
    "session_chunks": rf"""
        with recursive {_TURNS}, ty as (select *, case when number > 0 then number end as session, len(string_split_regex(trim(text), '\s+')) as words from tx),
        op as (select doc, turn_no, role, words, row_number() over (partition by doc order by turn_no) as k, max(case when role <> 'moderator' then turn_no end) over (partition by doc) as last from ty where session is null),
        pk as (
            select doc, 0::bigint as k, 0 as no, 0::bigint as filled, null::integer as turn_no from (select distinct doc from op where last is not null)
            union all
            select o.doc, o.k, case when o.turn_no <= o.last and (p.no = 0 or p.filled + o.words > 600) then p.no + 1 else p.no end, case when o.turn_no <= o.last and (p.no = 0 or p.filled + o.words > 600) then o.words else p.filled + o.words end, o.turn_no
            from pk p join op o on o.doc = p.doc and o.k = p.k + 1
        ), nu as (select doc, max(no) as most from pk group by doc),
        al as (
            select y.doc, y.turn_no, y.speaker, y.role, y.text, case when y.session is null then p.no else coalesce(n.most, 0) + y.session end as chunk_no, y.session from ty y left join pk p on p.doc = y.doc and p.turn_no = y.turn_no left join nu n on n.doc = y.doc
        )
        select doc, chunk_no::bigint as chunk_no, case when max(session) is not null then 'qa_session' else 'opening_remarks' end as chunk_type, coalesce(arg_min(speaker, turn_no) filter (role = 'management'), arg_min(speaker, turn_no)) as speaker,
            case when max(session) is not null then arg_min(speaker, turn_no) filter (role = 'analyst') end as analyst_speaker, string_agg(upper(role[1]) || role[2:] || ' (' || speaker || '): ' || text, chr(10) || chr(10) order by turn_no) as text,
            len(string_split_regex(trim(string_agg(upper(role[1]) || role[2:] || ' (' || speaker || '): ' || text, chr(10) || chr(10) order by turn_no)), '\s+'))::int as word_count, count(*)::int as n_turns
        from al where chunk_no is not null group by doc, chunk_no
    """,
    "run_delta": "select *, abs(n0 - n1) as delta from (select call_id, chunk_id, count_if(run_index = 0)::bigint as n0, count_if(run_index = 1)::bigint as n1 from raw_items group by all)",
    "arm_scores": r"""
        with b as (select prompt_version, scrip, count_if(credibility_scorable) / count(*) as share from guidance_items group by all) select prompt_version, count(*) as companies, round(avg(share), 6) as mean_share, count_if(share >= 0.70)::bigint as clear from b group by prompt_version
    """,
    "chunk_shares": r"""
        with b as (select call_id, count(*) as chunks, count_if(chunk_type = 'qa_session')::bigint as qa, max(chunk_id) filter (chunk_type = 'opening_remarks') as last_opening from chunks group by call_id) select *, round(qa / chunks, 6) as qa_share from b
    """,
    "earliest_filing": "select scrip, filing_id, news_dt from filings qualify row_number() over (partition by scrip order by news_dt nulls last, filing_id) = 1",
    "filing_quarters": r"""
        with f as (select *, case when month(news_dt) between 4 and 6 then 'Q4' when month(news_dt) between 7 and 9 then 'Q1' when month(news_dt) >= 10 then 'Q2' else 'Q3' end as quarter, (case when month(news_dt) >= 7 then year(news_dt) + 1 else year(news_dt) end)::int as fy from filings where scrip is not null and news_dt is not null and attachment is not null)
        select scrip, quarter, fy, attachment, news_dt from f qualify row_number() over (partition by scrip, quarter, fy order by news_dt, attachment) = 1
    """,
    "recent_quarters": r"""
        with f as (select *, case when month(news_dt) between 4 and 6 then 'Q4' when month(news_dt) between 7 and 9 then 'Q1' when month(news_dt) >= 10 then 'Q2' else 'Q3' end as quarter, (case when month(news_dt) >= 7 then year(news_dt) + 1 else year(news_dt) end)::int as fy from filings where scrip is not null and news_dt is not null and attachment is not null),
        q as (select scrip, fy, quarter, attachment from f qualify row_number() over (partition by scrip, quarter, fy order by news_dt, attachment) = 1)
        select scrip, fy, quarter, attachment from q qualify row_number() over (partition by scrip order by fy desc, quarter desc, attachment) <= 2
    """,
    "sector_top": r"select regexp_extract(name, '^\S+\s+(.*?)(?:\s+(?:Limited|Ltd\.?))?$', 1) as sector, count(*) as companies from company_master group by 1 order by companies desc, sector limit 15",
    "status_kinds": "select coalesce(user_id % 10, -1) as batch, coalesce(event_type, 'all') as kind, count(*) as n from events group by rollup (user_id % 10, event_type)",
    "token_usage": r"""
        with e as (select event_type, coalesce((props::json ->> '$.k')::bigint, 0) as k, props from events) select event_type, sum(k)::bigint as prompt, sum(k % 7)::bigint as cached, sum(k % 5)::bigint as completion, coalesce(round(100 * sum(k % 7) / nullif(sum(k), 0), 4), 0) as cached_pct from e group by event_type
    """,
    "trailing_growth": rf"with {_SERIES}, {_BASE(2001)} select company, round(revenue, 2) as revenue, round(pat, 2) as pat, net_margin, status, case when status = 'ok' then pat_cagr0 end as pat_cagr, revenue_cagr from base",
    "series_pivot": rf"with {_SERIES} select company, fy, round(sales, 2) as sales, round(net_profit, 2) as net_profit from series0",
    "overlap_divergence": rf"""
        with {_SERIES}, con as (select * from series0 where company % 5 <> 0 and (company % 3 <> 0 or fy > 1999)), std as (select company, fy, sales * case when company % 2 = 0 then 1.05 else 1.5 end as sales from series0 where company % 7 <> 0)
        select company, round(max(abs(a.sales - b.sales) / b.sales * 100), 1) as divergence from con a join std b using (company, fy) where a.sales <> 0 and b.sales <> 0 group by company
    """,
    "series_splice": rf"""
        with {_SERIES}, con as (select * from series0 where company % 5 <> 0 and (company % 3 <> 0 or fy > 1999)),
        std as (select company, fy, sales * case when company % 2 = 0 then 1.05 else 1.5 end as sales, net_profit * case when company % 2 = 0 then 1.05 else 1.5 end as net_profit from series0 where company % 7 <> 0),
        dv as (select company, round(max(abs(a.sales - b.sales) / b.sales * 100), 1) as divergence from con a join std b using (company, fy) where a.sales <> 0 and b.sales <> 0 group by company),
        c as (select company, bool_or(fy = 2001) as cb, bool_or(fy = 1998) as cp, count(*) as cn from con group by company), s as (select company, bool_or(fy = 2001) as sb, bool_or(fy = 1998) as sp, count(*) as sn from std group by company),
        fa as (
            select company, coalesce(cn, 0) >= coalesce(sn, 0) as longer, case when coalesce(cb, false) and coalesce(cp, false) then 'consolidated' when coalesce(cb, false) and coalesce(sp, false) and divergence < 10 then 'standalone_borrowed'
                when coalesce(cb, false) then 'consolidated_short' when coalesce(sb, false) then 'standalone_only' else 'fallback_richest' end as source from c full join s using (company) left join dv using (company)
        ), r as (
            select con.*, source from con join fa using (company) where source in ('consolidated', 'consolidated_short') or source = 'standalone_borrowed' and fy <> 1998 or source = 'fallback_richest' and longer
            union all select std.*, source from std join fa using (company) where source = 'standalone_only' or source = 'standalone_borrowed' and fy = 1998 or source = 'fallback_richest' and not longer
        ) select company, fy, round(sales, 4) as sales, round(net_profit, 4) as net_profit, source from r
    """,
    "driver_ladder": rf"with {_ITEMS}, {_drivers(False, True)} select company, block, class, rank, ord from dr",
    "block_growth": rf"with {_ITEMS}, {_drivers(True, False)}, {_FUND}, {_growth(True)} select company, block, base, bull from growth",
    "block_growth_plain": rf"with {_ITEMS}, {_drivers(False, True)}, {_FUND}, {_growth(False)} select company, block, base, bull, basis from growth",
    "acceleration_rank": rf"""
        with {_ITEMS}, {_drivers(True, False)}, {_FUND}, {_growth(True)}, {_BLOCKS}, r as (select *, near_base is not null and (long_base is null or near_base >= long_base) as near from fund left join blocks using (company)),
        s as (select *, case when near then near_base else long_base end as fwd_base, case when near then near_bull else long_bull end as fwd_bull, case when near then 'near' when long_base is not null then 'long' else '—' end as fwd_horizon from r)
        select company, status, pat_cagr, near_base, long_base, fwd_horizon, fwd_base, fwd_bull, case when status = 'ok' and fwd_base is not null then round(fwd_base - pat_cagr, 1) end as accel_base, case when status = 'ok' and fwd_base is not null then round(fwd_bull - pat_cagr, 1) end as accel_bull from s
    """,
    "revenue_rank": rf"""
        with {_ITEMS.replace("case when metric in ('pat_absolute', 'pat_growth_pct') then 'pat' when", "case when").replace("when metric in ('ebitda_margin_pct', 'pbt_margin_pct') then 'margin' end", "end")}, {_drivers(True, False)},
        {_FUND.replace("pat as current_pat, net_margin,", "revenue as current_pat, 100.0::double as net_margin,").replace("status, case when status = 'ok' then pat_cagr0 end as pat_cagr", "case when revenue_cagr is not null then 'ok' else 'missing' end as status, revenue_cagr as pat_cagr")}, {_growth(True)}, {_BLOCKS},
        s as (select *, greatest(near_base, long_base) as fwd_base, case when near_base is not null and (long_base is null or near_base >= long_base) then near_bull else long_bull end as fwd_bull from fund left join blocks using (company))
        select company, status, fwd_base, fwd_bull, case when status = 'ok' then round(fwd_base - pat_cagr, 1) end as accel_base from s
    """,
    "profit_grid": rf"with {_SERIES} select company as key, fy, sales, net_profit from series0",
    "company_snapshot": rf"""
        with {_SERIES}, l as (select company as key, arg_max(fy, fy) as fy, arg_max(sales, fy) as revenue, arg_max(net_profit, fy) as pat from series0 group by company),
        m as (select *, round(nullif(pat, 0) / nullif(revenue, 0) * 100, 2) as net_margin, (key % 40 + 0.5)::double as pe, (key * 1000)::double as mcap, round(nullif(pat, 0) * 4, 1) as forward_pat from l)
        select key, 'Mar ' || fy as fiscal_year, revenue, pat, net_margin, pe, mcap, forward_pat, round(nullif(mcap, 0) / nullif(forward_pat, 0), 1) as forward_pe from m
    """,
    "forward_peg_rank": rf"""
        with {_ITEMS}, {_drivers(False, True)}, {_FUND}, {_growth(False)}, {_BLOCKS} select company, forward_pe, greatest(near_base, long_base) as best_base, round(nullif(forward_pe, 0) / nullif(greatest(near_base, long_base), 0), 2) as forward_peg from fund left join blocks using (company)
    """,
    "other_signals": r"""
        select concat_ws('/', scrip, call_id) as company, string_agg(trim('[' || level || '] ' || coalesce(metric, '') || case when coalesce(guidance_value, '') <> '' then ': ' || guidance_value || ' ' || coalesce(guidance_unit, '') || ' ' || coalesce(currency, '') else '' end || ' by ' || coalesce(timeline, '')), ' | ' order by guidance_id) as signals
        from guidance_items where level <> 'company' group by scrip, call_id
    """,
    "attachment_rank": r"""
        select call_id, attachment, contains(lower(coalesce(headline, '')), 'transcript') as says from filings where call_id is not null and attachment is not null
        qualify row_number() over (partition by call_id order by contains(lower(coalesce(headline, '')), 'transcript') desc, news_dt desc nulls last, attachment) = 1
    """,
    "turn_ends": r"""
        with t as (select call_id, char_start, min(turn_id) as turn_no from turns where char_start is not null group by all), e as (select call_id, max(char_end) as total from turns group by call_id)
        select t.call_id as doc, turn_no, char_start, coalesce(lead(char_start) over (partition by t.call_id order by char_start, turn_no), total) as char_end from t join e on t.call_id is not distinct from e.call_id
    """,
    "stride_sample": r"""
        with m as (select scrip, bse_mcap_cr, row_number() over (order by bse_mcap_cr nulls last, scrip) - 1 as place, count(*) over () as n from company_master), i as (select distinct floor(i * (select count(*) from company_master) / 37.0::double)::bigint as place from range(37) r(i))
        select scrip, bse_mcap_cr from m where n <= 37 or place in (select place from i)
    """,
    "master_union": r"""
        with f as (select scrip, ticker, isin, name, 'BSE' as exchanges from company_master where contains(exchanges, 'BSE')), s as (select '' as scrip, ticker, isin, name, 'NSE' as exchanges from company_master where contains(exchanges, 'NSE'))
        select * from f union all select * from s where trim(coalesce(isin, '')) = '' or isin not in (select isin from f where trim(coalesce(isin, '')) <> '')
    """,
    "slug_sets": r"""
        with f as (select distinct scrip from filings where scrip is not null), m as (select distinct scrip from company_master where scrip is not null)
        select 'both' as what, count(*) as n from (from f intersect from m) union all select 'any', count(*) from (from f union from m) union all select 'listed_only', count(*) from (from m except from f)
    """,
    "filled_links": r"""
        with a as (select call_id, attachment, filing_id, 0 as p from filings where call_id is not null and attachment is not null and filing_id % 2 = 0 union all select call_id, 'mirror/' || attachment, filing_id, 1 from filings where call_id is not null and attachment is not null)
        select call_id, attachment, filing_id from a qualify row_number() over (partition by call_id order by p, filing_id) = 1
    """,
    "exact_first": "select guidance_id as ord from guidance_items qualify row_number() over (partition by scrip, metric, guidance_value, timeline order by guidance_id) = 1",
    "best_passage": rf"""
        with k as (
            select *, {_KEY} as vk, upper(trim(regexp_replace(coalesce(timeline, ''), '\s+', ' ', 'g'))) as tk,
                coalesce(list_bool_or(list_transform(regexp_extract_all(coalesce(timeline, ''), '(\d{{2,4}})', 1), lambda y: contains(passage, (case when y::int > 100 then y::int else y::int + 2000 end)::varchar)
                    or regexp_matches(lower(passage), 'fy\s*''?' || lpad((y::int % 100)::varchar, 2, '0') || '\b') or regexp_matches(passage, '''' || lpad((y::int % 100)::varchar, 2, '0') || '\b'))), false) as told from guidance_items
        ) select guidance_id as ord, min(guidance_id) over (partition by scrip, metric, vk, tk, level) as group_order from k
        qualify row_number() over (partition by scrip, metric, vk, tk, level order by told desc, length(coalesce(passage, '')) desc, guidance_id) = 1
    """,
    "date_windows": r"""
        with r as (select scrip, min(call_date) as a, max(call_date) as b from filings where scrip is not null and call_date is not null group by scrip), w as (select scrip, b, unnest(range(a::timestamp, b::timestamp + interval 1 day, interval 28 day))::date as start from r)
        select scrip, start, least(start + 27, b)::date as "end" from w
    """,
    "page_scrape": r"""select scrip as key, round(bse_mcap_cr, 0) as mcap, trim(name) as name, concat_ws(' & ', exchanges, ticker) as sector, name as industry from company_master""",
    "page_links": r"select scrip as doc, i::int as ord, ['https://x.invalid/' || scrip || '.pdf', 'https://x.invalid/' || coalesce(ticker, 'none')][i + 1] as url from company_master, range(2) r(i)",
    "page_calls": rf"with {_ORDERED_CALLS} select key, ord, date, fy, quarter, transcript_url from cl",
    "call_picks": rf"with {_ORDERED_CALLS} select key, fy, quarter, transcript_url from cl qualify row_number() over (partition by key, fy, quarter order by transcript_url is null, ord) = 1",
    "ground_truth_blocks": r"select guidance_id::int as id, metric, nullif(nullif(trim(guidance_value), ''), 'null') as guidance_value from guidance_items where passage is not null and metric is not null",
    "turn_sessions": rf"with {_TURNS} select doc, turn_no, case when number > 0 then number end as session from tx",
    "batch_requests": r"select doc_id as doc, length(text)::int as chars, sha256('Read: {transcript}') as prompt_sha, sha256('{}') as schema_sha, sha256('Read: ' || coalesce(text, '')) as request_sha from documents",
    "top_overlap": rf"""
        with {_SERIES}, a as (select company from series0 where fy = 1999 order by round(sales, 2) desc, company limit 200), b as (select company from series0 where fy = 2000 order by round(sales, 2) desc, company limit 200) select count(*) as shared from a join b using (company)
    """,
    "composite_score": r"""
        with m as (select scrip, scrip::bigint as n from company_master) select scrip, round((n % 11)::double * 0.15::double + (n % 7)::double * 0.20::double + (case when n % 5 <> 0 then n % 9 else 0 end)::double * 0.35::double + (n % 3)::double * 0.25::double + case when n % 4 = 0 then 0.5::double else 0 end, 6) as score from m
    """,
    "delivery_ratio": rf"""
        with {_SERIES}, s as (select company, fy, round(sales, 2) as a, round(net_profit * 20, 2) as g from series0) select company, fy as quarter_no, round(avg(a / nullif(g, 0)) over (partition by company order by fy rows between 3 preceding and current row), 6) as delivery from s
    """,
    "excess_returns": rf"""
        with {_SERIES}, s as (select company, fy as day, round(sales, 2) as close from series0), m as (select day, (sum(close::decimal(20, 2)) / 1000)::double as level from s group by day), j as (select * from s join m using (day))
        select company, day, round(lead(close, 1) over w / close - lead(level, 1) over w / level, 6) as excess_1, round(lead(close, 2) over w / close - lead(level, 2) over w / level, 6) as excess_2 from j window w as (partition by company order by day)
    """,
    "crore_amounts": rf"""
        with a as (
            select guidance_id, extracted_at::date as day, replace(replace(replace(trim(guidance_value), ',', ''), '–', '-'), 'x', '') as v, upper(coalesce(currency, '')) = 'USD' as usd, replace(replace(rtrim(trim(lower(coalesce(guidance_unit, ''))), '.'), 'mn', 'million'), 'bn', 'billion') as u,
                replace(replace(lower(guidance_unit), 'mn', 'million'), 'bn', 'billion') as w from guidance_items
        ), b as (
            select *, try_cast(nullif(regexp_extract(v, '^({_NUM})(?:\s*-\s*({_NUM}))?$', 1), '') as double) as lo, (case when day is null then 83.4 else [{_RATES}][least(greatest((year(day) - 2013) * 4 + quarter(day) - 1, 0), 51) + 1] end)::double as usdinr from a
        )
        select guidance_id, usdinr, round(case when u in ('crore', 'crores', 'crs', 'cr') then lo * case when usd then usdinr * 1 else 1 end when u in ('lakh', 'lakhs') then lo * case when usd then usdinr * 0.01::double else 0.01::double end
                when u in ('million', 'millions') then lo * case when usd then usdinr * 0.1::double else 0.1::double end when u in ('billion', 'billions') then lo * case when usd then usdinr * 100 else 100 end when u in ('', '%', 'times') then lo end, 4) as crore,
            round(case when w in ('crore', 'cr') then lo when w = 'lakh' then lo * 0.01::double when w = 'million' then lo * case when usd then 8.3::double else 0.1::double end when w = 'billion' then lo * case when usd then 8300 else 100 end end, 4) as rough_crore from b
    """,
    "implied_growth": rf"with {_IMPLIED} select guidance_id, years_lo, years_hi, status, round(case when status = 'ok' then low end, 6) as low, round(case when status = 'ok' then high end, 6) as high, reason from g5",
    "gate_scores": rf"""
        with {_IMPLIED}, s as (select concat_ws('/', scrip, metric) as slug, guidance_id % 2 as odd, arg_min(struct_pack(m := metric, st := status, l := round(case when status = 'ok' then low end, 6)), guidance_id) as x from g5 group by all)
        select count(*) as companies, count_if((lower(coalesce(a.x.m, 'none')) <> 'none') = (lower(coalesce(b.x.m, 'none')) <> 'none'))::bigint as has_target_agree,
            count_if(lower(coalesce(a.x.m, 'none')) <> 'none' and lower(coalesce(b.x.m, 'none')) <> 'none' and a.x.st = 'ok' and b.x.st = 'ok')::bigint as both_ok,
            count_if(lower(coalesce(a.x.m, 'none')) <> 'none' and lower(coalesce(b.x.m, 'none')) <> 'none' and a.x.st = 'ok' and b.x.st = 'ok' and abs(a.x.l - b.x.l) <= 0.05)::bigint as within_tolerance
        from s a join s b on a.slug = b.slug and a.odd = 0 and b.odd = 1
    """,
    "label_counts": r"""
        with c as (select chunk_key, regexp_replace(text, '(?:Moderator|Management|Analyst) \(([^)]*)\):', '\1:', 'g') as t from chunks), p as (select chunk_key, unnest(string_split_regex(t, '(?:\n[ \t]*){2,}')) as p from c),
        n as (select chunk_key as doc, trim(regexp_extract(p, '^\s*((?:[A-Z]\.\s+){0,2}[A-Z][a-z]+(?:\s+[A-Z][a-z.]*){0,3})\s*:', 1)) as name from p) select doc, name, count(*) as n from n where name <> '' group by all
    """,
    "metric_classes": r"""
        with r as (select item_id, lower(coalesce(metric_description, '')) as d, regexp_matches(lower(coalesce(guidance_unit, '')), '%|percent|pct|bps') as p from raw_items)
        select item_id, case when contains(d, 'commission') then 'commissioning_event' when regexp_matches(d, 'capex|capital outlay') then 'capex_absolute' when contains(d, 'gross margin') then 'gross_margin_pct' when regexp_matches(d, 'ebitda margin|operating margin') then 'ebitda_margin_pct'
            when contains(d, 'pbt margin') then 'pbt_margin_pct' when contains(d, 'volume growth') then 'volume_growth_pct' when regexp_matches(d, 'pat growth|profit growth') then case when p then 'pat_growth_pct' else 'pat_absolute' end
            when regexp_matches(d, '\bpat\b|profit after tax') then 'pat_absolute' when regexp_matches(d, 'revenue growth|sales growth') then 'revenue_growth_pct' when regexp_matches(d, 'revenue|topline') then case when p then 'revenue_growth_pct' else 'revenue_absolute' end
            when contains(d, 'capacity addition') then 'capacity_addition'
            else 'other_' || regexp_replace(regexp_replace(regexp_replace(d, '\s+(of|by|in)\s.*$', ''), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') end as metric from r
    """,
}
