"""Word lists of the text checks. All of them are fixed values: results depend on them as they stand."""

from __future__ import annotations

#: Phrases that a Swahili text must not have, searched without regard to case.
BAD_PHRASES: tuple[str, ...] = (
    "jioni ghafla", "fungishia", "vichepeto", "formuleni", "formuliza", "imilisha", "kunanyua", "kunyonya majani",
    "kunyonya mafuta", "kunyonyesha majani", "kunyonyesha mafuta", "kinyesi la pua", "kinyesi cha pua",
    "mchana wa kuku", "mchana una damu", "usafishaji wa mchana", "maziwa ya kahawa", "karanga za kahawa",
    "ubora wa karanga", "majaribio ya udongo", "ugali wa mwanzo", "chovya ya chipukizi", "viumbe vya nyanya",
    "viumbe vikaribie", "viumbe vizuri", "mtandaoni", "piga sungura", "majani ya majani", "kaanga vipande jua",
    "kaanga vipande", "nanga larvae", "straw mulch", "paddy rice", "formuliza rations", "mchanga wa ngano",
    "vitongoji vilivyoinuliwa", "mbolea iliyoyeyuka", "matibabu ya mbegu ya mnyororo", "asidi ya fomiki",
    "kisulfuli", "sprekla", "viboko vya madini", "kuogelea kinyesi", "utamaduni wa bakteria", "node za limfa",
    "bots za pua", "joto la ukandamizaji", "kununua majani", "kununua mafuta", "kununua kwenye", "kununua dawa",
    "changanya na kununua", "beetle wa kike", "nyuki wa parasiti", "mto wa bakteria", "kuja kwa roho",
    "kikombe, ukelea", "shinyanga", "mchafu wa shina", "kinyume cha kutosha", "kinyesi kinatolewa",
    "kunyonyeza kinyesi", "vilivyochomwa", "yamefukuzwa", "magugu wa vitunguu", "piga mgongo", "hunyunyizia maji",
    "Mavazi mawili", "ponya mbegu", "Sasa viambato", "fungua kulingana", "jioni ya kuchelewa", "ng'ombe kavu",
    "mapopo", "wanyama wa asili", "kupiga mayai", "weevili", "ugali wa maji", "weka vibaya", "funika vibaya",
    "yasiyo wa wageni", "funua kifuniko", "komposti ya mashine", "komposti iliyoyeyuka", "samadi iliyoyeyuka",
    "msimu ya", "safi, safi", "mkia wa mkia", "nanga viambato", "sanitiza", "kalibrated", "ideali", "fungashio",
    "yayeyesha", "iandamizwe", "kununyizia", "kununyiza",
)

#: English terms that should have been translated, searched as whole words.
ENGLISH_TERMS: tuple[str, ...] = (
    "early blight", "late blight", "bacterial wilt", "blight", "wilt", "stem borer", "fall armyworm",
    "coffee berry borer", "borer", "whiteflies", "whitefly", "thrips", "leafminer", "tomato leafminer", "mites",
    "larvae", "pupae", "nozzle", "sprayer", "sprinkler", "sprinklers", "spray", "PPE", "mask", "herbicide",
    "fungicide", "biofungicide", "diverter", "diverters", "trellis", "sealant", "tray", "trays", "strip", "strips",
    "dryer", "silos", "silo", "supers", "mulch", "mulching", "starch", "bran", "silage", "loam", "slope",
    "tillering", "ration", "rations", "legume", "legumes", "solution", "syrup", "active", "calibrated", "batch",
    "regenerative", "somatic", "anticoccidial", "molasses", "neem oil", "years", "year", "yr", "weeks", "week",
    "months", "month", "days", "day", "hours", "hour", "apart", "Livestock Research Organization", "ideal", "keep",
)

#: English headings, searched at the start of a line and before a colon.
ENGLISH_HEADINGS: tuple[str, ...] = (
    "Cultivation", "Harvesting", "Processing", "Feeding Rate", "Region Specific Note", "General Biosecurity",
    "Health Monitoring", "Veterinary Collaboration", "Probiotics", "Premix", "Electrolytes", "Early Blight",
    "Late Blight", "Bacterial Wilt",
)

#: Patterns that a normalised Swahili text must not match, with what is said of a match.
BAD_PATTERNS: tuple[tuple[str, str], ...] = (
    (r"\b(?:L|kg|g|t|mL|ml)\s+ha\s+1\b", "malformed unit: use L/ha, kg/ha, etc."),
    (r"\b(?:L|kg|g|t|mL|ml)\s*/\s*ha\s+1\b", "malformed unit: use L/ha, kg/ha, etc."),
    (r"\b(?:L|kg|g|t|mL|ml)\s+m\s+2\b", "malformed unit: use /m²"),
    (r"\b(?:km|m|cm|mm|L|mL|ml)\s+h\s+1\b", "malformed unit: use /h"),
    (r"\b(?:km|cm|mm|m)\s*[-]?\s*1\b", "malformed unit: use /m (e.g. 2-4 L/m), never m 1 / m-1"),
    (r"\bm\s+2\b", "malformed unit: use m²"),
    (r"\(.*\b(?:ft|feet|in|inches)\b.*\)", "added imperial conversion"),
    (r"\b(?:viumbe|kiumbe)\b", "use miche/vikonyo/mmea or the animal's name; avoid viumbe/kiumbe"),
    (r"\bkibio\b", "invented form: write kibiolojia / kibiashara, never kibio"),
    (r"\bmanyu\b", "invented form for nozzle: write kichwa cha kunyunyizia"),
    (r"\bspra\b", "clipped English form: write vyombo vya kunyunyizia, never spra"),
    (r"\bdalili za kutokwa(?!\s+na\b)", "incomplete phrase: write kuharisha or kutokwa na choo"),
)

#: Words that hint at a language, searched in the lower-cased text between blanks.
LANGUAGE_HINTS: dict[str, tuple[str, ...]] = {
    "sw": ("na ", "ya ", "wa ", "ni ", "kwa ", "kama ", "panda", "maji", "udongo", "daktari", "mbolea", "mahindi", "ndizi", "ng'ombe", "ndama"),
    "en": (" the ", " and ", " your ", " should ", " check ", " water ", " soil ", " veterinarian "),
}

#: Fixed value: a marker of the chat template that an answer must not have.
TEMPLATE_LEAK = "<|turn>"
#: A dose, a question back, and a first step, in an answer.
DOSE = r"\b\d+(?:\.\d+)?\s*(?:ml|millilit(?:er|re)|g|gram|kg|lit(?:er|re))(?:\s*/\s*(?:l|lit(?:er|re)|ha|acre|ekari))?"
ASKS_BACK = r"\?|which crop|what crop|location|eneo|aina gani|mazao gani|wapi"
FIRST_STEP = r"\b(1\.|2\.|first|then|check|provide|keep|panda|chunguza|weka|hakikisha)\b"

#: Rewrites of unit spellings, in the order in which they apply.
UNIT_REWRITES: tuple[tuple[str, str], ...] = (
    (r"\b(\d)-(\d{3})\b", "$1$2"),
    (r"\b1-?109\s+(cfu|conidia)\b", "10^9 $1"),
    (r"\b(cfu|conidia)\s+1-?109\b", "$1 10^9"),
    (r"\b([a-z]{4,})\s*spp\.?", "$1 spp."),
    (r"\b(l|kg|g|t|ml)\s*/?\s*ha\s*[-]?\s*1\b", "$1/ha"),
    (r"\b(l|kg|g|t|ml)\s+ha\b", "$1/ha"),
    (r"\b(kg|g|t)\s+(n|p2o5|k2o|p|k)\s+ha\b", "$1 $2/ha"),
    (r"\b(l|kg|g|t|ml)\s*ha\s*\^\s*-\s*1\b", "$1/ha"),
    (r"\b(l|kg|g|t|ml)\s*/?\s*m\s+2\b", "$1/m²"),
    (r"\b(l|ml)\s+m\s*[-]?\s*1\s+h\s*[-]?\s*1\b", "$1/m/h"),
    (r"\b(km|m|cm|mm|l|ml)\s*h\s*[-]?\s*1\b", "$1/h"),
    (r"\b(l|ml|kg|g|t)\s*d\s*[-]?\s*1\b", "$1/d"),
    (r"\b(cfu|conidia)\s*/?\s*l\s*[-]?\s*1\b", "$1/L"),
    (r"/\s*ha\s*[-]?\s*1\b", "/ha"),
    (r"\bha\s*[-]?\s*1\b", "ha"),
    (r"(\d)\s*m\s*2(?!\.\d)\b", "$1 m²"),
    (r"\bm\s+2(?!\.\d)\b", "m²"),
    (r"\bm\s*\^\s*2\b", "m²"),
)

#: Rates that are written with blanks around the stroke.
RATE_REWRITES: tuple[tuple[str, str], ...] = (
    (r"\b(kg|g|t|l|ml|mm|cm|km|m)\s*/\s*(ha|acre|m²|h|d)\b", "$1/$2"),
    (r"\b(mara|baada|kabla)\s*/\s*(siku|wiki|mwezi|mwaka)\b", "$1/$2"),
)
#: Fixed value: an acre rate with a wrong conversion behind it.
WRONG_CONVERSION = r"(\b\d+(?:[.,]\d+)?\s*kg\s*/\s*acre\s*)\(\s*\d+(?:[.,]\d+)?\s*kg\s*/\s*ha\s*\)"
#: Imperial measures, alone and inside parentheses.
IMPERIAL = r"\d+(?:[.,]\d+)?\s*(?:ft|feet|in|inches|yd|yards|lb|lbs|pounds?)\b"
IMPERIAL_ASIDE = r"\([^)]*\b(?:ft|feet|in|inches|yd|yards|lb|lbs)\b[^)]*\)"
