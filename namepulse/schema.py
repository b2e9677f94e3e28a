"""Record layout and the constants every pipeline shares."""

# The 27 fields of one record, in file order.
RECORD_DDL = """
    id string,
    date timestamp,
    sourceCollectionId int,
    sourceCommonNames string,
    documentIdentifier string,
    counts string,
    v2Counts string,
    themes string,
    v2Themes string,
    locations string,
    v2Locations string,
    persons string,
    v2Persons string,
    organizations string,
    v2Organizations string,
    v2Tone string,
    dates string,
    gCam string,
    sharingImages string,
    relatedImages string,
    socialImageEmbeds string,
    socialVideoEmbeds string,
    quotations string,
    allNames string,
    amounts string,
    translationInfo string,
    extras string
"""

# Names that are artefacts of page furniture, never counted.
STOP_NAMES = (
    "Type ParentCategory",
    "CategoryType ParentCategory",
    "Read Full",
    "Read Full Blog",
)

# Formats, separators, positions and sizes.
FIELD_SEPARATOR = "\t"
ENTRY_SEPARATOR = ";"
OFFSET_SEPARATOR = ","
RECORD_TIME_FORMAT = "yyyyMMddHHmmss"
DAY_FORMAT = "yyyy-MM-dd"
SEGMENT_TIME_FORMAT = "yyyyMMddHHmm"
SEGMENT_SUFFIX = "00.gkg.csv"
FIRST_RECORD_KEY = "20150218230000-0"
ID_FIELD = 0
DATE_FIELD = 1
NAMES_FIELD = 23
SEGMENT_MINUTES = 15
LOOKBACK_MINUTES = 60
DAILY_TOP = 10
LIVE_TOP = 100

N_FIELDS = RECORD_DDL.count(",") + 1
