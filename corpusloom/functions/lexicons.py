"""Default lexicons as data; every operator takes its lexicon as a parameter.

Word lists are sets and are written in alphabetical order. Gazetteer rows are
(category, canonical name, place, kind, aliases); their order decides ties.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path


def _set(text: str) -> frozenset[str]:
    return frozenset(text.split())


SINGLISH = _set("""
 ado aida amma aney api apige balanava beheth bonna da doctor eda ehema eka enna epane eyaa eyage ganna gedara harida hinda
 hitinava hospital innava ithin kanna karanna kawada kawda keeyada ko koheda kohomada lu mage mama meka mokada mokakda monawada
 namuth nan ne neda oya oyage pasala puluwanda thaththa umba yanna ද
""")  # fmt: skip
TAMILISH = _set("""
 aama anga appuram aval avan avanga enga enna epdi eppo ethu evlo illai inga keelu la lam le mudiyuma naan naanga nee neengal
 pannunga paru pola ponga poo puriyutha saapdu seri sollu thaan theriyuma um vaa vanga yaru
""")  # fmt: skip
HEALTH_TERMS = _set("appointment clinic dengue doctor emergency fever hospital medicine opd patient pharmacy vaccine")

#: Spelling corrections of romanized text (those that change anything).
SPELLINGS = {"clinik": "clinic", "docter": "doctor", "hosiptal": "hospital", "kohenda": "koheda", "vacine": "vaccine"}


@dataclass(frozen=True)
class Markers:
    """The marker sets of the romanized classifier."""

    singlish: frozenset[str] = SINGLISH
    tamilish: frozenset[str] = TAMILISH
    neutral: frozenset[str] = HEALTH_TERMS

    @classmethod
    def load(cls, path: str) -> Markers:
        """From JSON with ``singlish_markers`` and ``tamilish_markers`` (category to list); absent keys keep defaults."""
        data = json.loads(Path(path).read_text("utf-8"))
        flat = lambda key, default: frozenset(w.lower() for ws in data[key].values() for w in ws) if key in data else default
        return cls(flat("singlish_markers", SINGLISH), flat("tamilish_markers", TAMILISH), HEALTH_TERMS)


@dataclass(frozen=True)
class Name:
    category: str
    canonical: str
    place: str = ""
    kind: str = ""
    aliases: tuple[str, ...] = field(default=())


def _hospital(place: str, kind: str, canonical: str, *aliases: str) -> Name:
    return Name("hospital", canonical, place, kind, aliases)


GAZETTEER: tuple[Name, ...] = (
    _hospital("Colombo", "teaching", "National Hospital of Sri Lanka", "Colombo National Hospital", "National Hospital"),
    _hospital("Colombo", "teaching", "Colombo South Teaching Hospital", "CSTH", "Kalubowila Hospital"),
    _hospital("Colombo", "children", "Lady Ridgeway Hospital", "Lady Ridgeway", "LRH"),
    _hospital("Colombo", "maternity", "De Soysa Hospital for Women", "Castle Street Hospital", "De Soysa"),
    _hospital("Ragama", "teaching", "Ragama Teaching Hospital", "North Colombo", "Ragama Hospital"),
    _hospital("Negombo", "district", "Negombo District Hospital", "Negombo Hospital"),
    _hospital("Galle", "teaching", "Karapitiya Teaching Hospital", "Galle Hospital", "Karapitiya"),
    _hospital("Matara", "general", "Matara General Hospital", "Matara Hospital"),
    _hospital("Kandy", "teaching", "Kandy Teaching Hospital", "Peradeniya Hospital", "Kandy Hospital"),
    _hospital("Badulla", "provincial", "Badulla Provincial Hospital", "Badulla Hospital"),
    _hospital("Ratnapura", "provincial", "Ratnapura Provincial Hospital", "Ratnapura Hospital"),
    _hospital("Kurunegala", "teaching", "Kurunegala Teaching Hospital", "Kurunegala Hospital"),
    _hospital("Anuradhapura", "teaching", "Anuradhapura Teaching Hospital", "Anuradhapura Hospital"),
    _hospital("Batticaloa", "teaching", "Batticaloa Teaching Hospital", "Batticaloa Hospital"),
    _hospital("Jaffna", "teaching", "Jaffna Teaching Hospital", "Jaffna Hospital"),
    Name("disease", "Typhoid", aliases=("ටයිෆොයිඩ්", "typhoid fever")),
    Name("disease", "Chickenpox", aliases=("සුළු වසූරිය", "chicken pox")),
    Name("disease", "Malaria", aliases=("மலேரியா", "මැලේරියා")),
    Name("disease", "Tuberculosis", aliases=("காசநோய்", "ක්ෂය", "TB")),
    Name("disease", "COVID-19", aliases=("කොවිඩ්", "corona", "covid")),
    Name("disease", "Leptospirosis", aliases=("මූත්‍ර රෝග", "rat fever", "lepto")),
    Name("disease", "Dengue Fever", aliases=("dengu", "டெங்கு", "ඩෙංගු", "dengue")),
    Name("symptom", "Rash", aliases=("skin rash", "rash", "சொறி", "කුෂ්ඨ")),
    Name("symptom", "Diarrhea", aliases=("diarrhea", "வயிற்று" "ப்போக்கு", "පාචනය")),
    Name("symptom", "Vomiting", aliases=("vomiting", "வாந்தி", "වමනය")),
    Name("symptom", "Cough", aliases=("kassa", "cough", "இருமல்", "කැස්ස")),
    Name("symptom", "Body Pain", aliases=("body ache", "உடல் வலி", "ශරීර වේදනාව")),
    Name("symptom", "Headache", aliases=("hisa radeema", "headache", "தலைவலி", "හිසරදය")),
    Name("symptom", "Fever", aliases=("fever", "una", "காய்ச்சல்", "උණ")),
    Name("clinic", "Dental Clinic", aliases=("பல்" " மருத்துவமனை", "දන්ත සායනය", "dental")),
    Name("clinic", "Eye Clinic", aliases=("eye opd", "ඇස් සායනය", "ophthalmology")),
    Name("clinic", "Maternal Clinic", aliases=("ante natal clinic", "මාතෘ සායනය", "antenatal")),
    Name("clinic", "Mental Health Clinic", aliases=("මානසික සෞඛ්‍ය", "psychiatry")),
    Name("clinic", "Vaccination Center", aliases=("தடுப்பூசி" " மையம்", "එන්නත්" " මධ්‍යස්ථානය", "vaccine center")),
    Name("clinic", "Dengue Clinic", aliases=("டெங்கு" " கிளினிக்", "ඩෙංගු සායනය", "dengue clinic")),
    Name("clinic", "OPD", aliases=("ஓபிடி", "opd", "Out Patient", "Outpatient Department")),
)


def load_gazetteer(path: str) -> tuple[Name, ...]:
    """From JSON: category (plural) to a list of {name, aliases, location, type}."""
    data = json.loads(Path(path).read_text("utf-8"))
    return tuple(
        Name(category.rstrip("s"), row["name"], row.get("location", ""), row.get("type", ""), tuple(row.get("aliases", ())))
        for category, rows in data.items() for row in rows
    )


#: Domains in the order that decides ties, with their keywords.
DOMAINS: dict[str, tuple[str, ...]] = {
    "dengue": ("aedes", "dengue", "DF", "DHF", "DSS", "fever", "hemorrhagic", "mosquito", "platelet", "டெங்கு", "ඩෙංගු"),
    "covid": ("antigen", "booster", "corona", "coronavirus", "covid", "isolation", "lockdown", "pandemic", "pcr", "quarantine", "rar test", "sars-cov", "කොවිඩ්"),
    "vaccination": ("bcg", "booster", "dose", "hepatitis", "immunization", "immunize", "jab", "mmr", "polio", "tetanus", "vaccination", "vaccine", "தடுப்பூசி", "එන්නත්"),
    "mental_health": ("anxiety", "bipolar", "counseling", "depression", "mental", "psychiatric", "psychology", "schizophrenia", "stress", "suicide", "therapy", "මානසික"),
    "maternal_health": ("antenatal", "childbirth", "delivery", "gynecology", "maternal", "maternity", "midwife", "obstetric", "postnatal", "pregnancy", "pregnant", "මාතෘ"),
    "child_health": ("baby", "child", "children", "infant", "newborn", "paediatric", "pediatric", "toddler", "குழந்தை", "ළමා"),
    "opd": ("appointment", "check-up", "checkup", "clinic", "consultation", "doctor", "opd", "out patient", "outpatient"),
    "emergency": ("1990", "911", "accident", "ambulance", "casualty", "critical", "emergency", "icu", "trauma", "urgent"),
    "pharmacy": ("beheth", "drug", "medication", "medicine", "pharmaceutical", "pharmacy", "prescription", "மருந்து"),
    "laboratory": ("blood test", "ct scan", "lab", "laboratory", "mri", "scan", "test", "ultrasound", "urine", "x-ray"),
    "dental": ("dental", "dentist", "oral", "teeth", "tooth", "பல்", "දන්ත"),
    "eye": ("eye", "ophthalmology", "optical", "optometry", "vision", "கண்", "ඇස්"),
}

DOMAIN_DESCRIPTIONS = {
    "dengue": "Dengue and its prevention", "covid": "COVID-19 and coronavirus", "vaccination": "Vaccines and immunization",
    "mental_health": "Mental health", "maternal_health": "Mothers and pregnancy", "child_health": "Children's health",
    "opd": "Outpatient services", "emergency": "Emergency services", "pharmacy": "Medicines and pharmacies",
    "laboratory": "Tests and laboratories", "dental": "Dental care", "eye": "Eye care", "general": "General health",
}

#: Intents in the order that decides ties: bodies of patterns that stand between word boundaries.
INTENTS: dict[str, tuple[str, ...]] = {
    "asking_location": (
        "address|directions?|enga|koheda|location|where", r"(?:closest|nearby|nearest|which)\s+(?:clinic|hospital)", r"how\s+to\s+(?:reach|go|get)",
        r"kohomada\s+yanne|koheda", r"(?:clinic|hospital)\s+eka\s+koheda", r"enga\s+irukku|enga",
    ),
    "asking_time": (
        r"eppo|hours?|keeyatada|schedule|when|what\s+time", r"(?:closing|opening|close|open)\s*(?:hours?|time)?", "weekend|weekday|morning|evening|afternoon",
        "keeyatada|keeyata", "kavadada|kawadada", r"evlo\s+neram|eppadi|eppo",
    ),
    "asking_symptoms": (
        "indication|signs?|symptom", r"what\s+(?:is|are)\s+the\s+symptoms?", r"how\s+(?:to|do\s+i)\s+know\s+if", "experiencing|suffering|feel(?:ing)?",
        r"roga\s+lakshana|lakshana",
    ),
    "asking_treatment": (
        "cure|medicine|remedy|treatment|treat", r"how\s+to\s+(?:heal|cure|treat)", r"what\s+(?:drug|medication|medicine)", r"should\s+i\s+(?:do|use|take)",
    ),
    "asking_appointment": (
        "appointment|reserve|schedule|book(?:ing)?", r"how\s+to\s+(?:get|make|book)\s+(?:an?\s+)?appointment", "enroll|registration|register",
        r"book\s+karanna|appointment\s+ganna",
    ),
    "asking_contact": ("call|contact|hotline|number|phone|telephone", "mobile|fax|email", r"how\s+to\s+(?:reach|call|contact)"),
    "emergency": ("ambulance|emergency|immediately|urgent", "1990|911|help", "critical|dying|severe|serious(?:ly)?", r"chest\s+pain|accident|bleeding|unconscious"),
    "general_info": (r"about|explain|information|tell\s+me|what\s+is", "understand|know|learn"),
}

#: Sentences that show what each intent means: (sentence, intent, place among the intent's sentences).
_EXAMPLES = (
    ("appointment ganna kohomada", "asking_appointment", 2), ("clinic eka keeyatada", "asking_time", 2),
    ("Colombo hospital enga irukku", "asking_location", 3), ("Contact number for emergency?", "asking_contact", 2),
    ("Emergency! Need ambulance now!", "emergency", 1), ("hospital eppo close", "asking_time", 3),
    ("How do I know if I have fever?", "asking_symptoms", 2), ("How to book an appointment?", "asking_appointment", 1),
    ("How to treat dengue at home?", "asking_treatment", 1), ("mage amma dengue clinic eka koheda", "asking_location", 2),
    ("My child is having severe fever", "emergency", 2), ("Tell me about dengue prevention", "general_info", 1),
    ("What are the symptoms of dengue?", "asking_symptoms", 1), ("What is COVID-19?", "general_info", 2),
    ("What is the hospital phone number?", "asking_contact", 1), ("What medicine should I take for fever?", "asking_treatment", 2),
    ("What time does the OPD open?", "asking_time", 1), ("Where is the dengue clinic?", "asking_location", 1),
)
INTENT_EXAMPLES = tuple((i, t) for t, i, _ in sorted(_EXAMPLES, key=lambda r: (list(INTENTS).index(r[1]), r[2])))

#: Reliability of pages whose host has the text in it; the first that fits, else the last.
RELIABILITY: tuple[tuple[str, float], ...] = tuple(
    (f"{office}gov.lk", share) for office, share in zip(("epid.", "health.", "moh.", ""), (0.95, 0.95, 0.9, 0.85))
) + (("other", 0.7),)
LEVELS = dict(low=0.3, medium=0.5, high=0.8, critical=1.0)

#: Words that make a link relevant; one is there twice and counts twice.
LINK_WORDS = (
    "clinic hospital disease vaccine health medical dengue leptospirosis cholera schedule doctor auruwedaya behethshalawa roga "
    "ennath pdf circular advisory report schedule"
).split()

#: Least shares in per cent that an audit asks for.
THRESHOLDS: tuple[tuple[str, str, float], ...] = (
    ("domain", "child_health", 5), ("domain", "maternal_health", 5), ("domain", "mental_health", 5),
    ("language", "english", 10), ("language", "sinhala", 20), ("language", "tamil", 15),
)
