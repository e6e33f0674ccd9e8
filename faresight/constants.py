"""Fixed values that must equal the pipeline being rebuilt, kept together in one place.

Fixed values (do not change; results depend on them):
- business time zone: Asia/Seoul
- Korean weekday names, Monday first: 월 화 수 목 금 토 일
- airline placeholder when a flight has no airline: "airline 여러개"
- route selection of the archive job: departures ICN, GMP; arrivals CJU plus every airport of the
  regions 일본 동남아 중국 유럽 미주 대양주 남미 중동 (in that order) of the region map
- aggregate retention: rows with fetched_date <= run date - 2 days are removed
- stream intake: 60 files per micro-batch, 1 minute processing-time trigger
- migration chunk: 30,000 batch ids per commit (kept only as a documented default; the Spark
  migration is one set-based pass over the whole id range)
"""

BUSINESS_ZONE = "Asia/Seoul"
WEEKDAYS_KR = ("월", "화", "수", "목", "금", "토", "일")
AIRLINE_PLACEHOLDER = "airline 여러개"

REFERENCE_DEPARTURES = ("ICN", "GMP")
REFERENCE_EXTRA_ARRIVALS = ("CJU",)
REFERENCE_ARRIVAL_REGIONS = ("일본", "동남아", "중국", "유럽", "미주", "대양주", "남미", "중동")

RETENTION_DAYS = 2
MAX_FILES_PER_TRIGGER = 60
TRIGGER_INTERVAL = "1 minute"

# Business keys.
FARE_KEY = ("air_id", "seat_class", "agt_code", "fetched_date", "fare_class")
FARE_COLUMNS = ("air_id", "seat_class", "agt_code", "adult_fare", "fetched_date", "fare_class")
AGG_KEY = ("route_key", "depart_year", "depart_month", "depart_day", "is_layover", "airline",
           "seat_class", "fare_class", "fetched_date")
AGG_COLUMNS = AGG_KEY + ("mean_price", "median_price", "ticket_count")
OFFER_KEY = ("seat_class", "airline", "agt_code", "fare_class")
