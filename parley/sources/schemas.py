"""Explicit schemas of the entities; nothing is inferred."""

TURN = "speaker string, role string, text string, page_start int, page_end int, char_start int, char_end int"
CHUNK = f"chunk_id string, chunk_type string, speaker string, analyst_speaker string, role string, page_start int, page_end int, char_start int, char_end int, text string, word_count int, turns array<struct<{TURN.replace(' ', ':').replace(',:', ',')}>>"
RAW_ITEM = "chunk_id string, passage string, speaker string, page_number int, metric_description string, guidance_value string, guidance_unit string, timeline string, run_index int"
ITEM = "passage string, speaker string, page_number int, metric string, guidance_value string, guidance_unit string, currency string, timeline string, horizon string, level string, track string, credibility_scorable boolean"
SANDBOX_ITEM = "metric string, value string, unit string, currency string, scope string, timeline string, passage string"
TARGET = "metric string, value string, unit string, currency string, timeframe string, passage string"
EXTRACTION = f"call_period string, items array<struct<{', '.join(f'{c.split()[0]}: {c.split()[1]}' for c in ITEM.split(', '))}>>"
RECORD = f"id bigint, company string, quarter string, prompt_version string, run_id string, extracted_at timestamp, {ITEM}"
EVAL_RUN = "run_id string, company string, quarter string, prompt_version string, recall double, precision double, gt_count int, llm_count int, tp_count int, run_at timestamp"
ANNOUNCEMENT = "SCRIP_CD string, SLONGNAME string, NEWS_DT string, ATTACHMENTNAME string, SUBCATNAME string, HEADLINE string, NSURL string"
FILING = "scrip string, name string, news_dt string, attachment string, nse_ticker string, slug string, headline string"
MASTER = "scrip string, ticker string, isin string, name string, nsurl string, bse_mcap_cr double, exchanges string"
LOG = "slug string, status string, pages int, bytes bigint, url string"

#: Names of the sandbox lineage and those of the current one.
RENAMES = {"value": "guidance_value", "unit": "guidance_unit", "scope": "level"}
