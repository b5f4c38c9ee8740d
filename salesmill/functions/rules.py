"""Fixed values of the cleaning profiles: replacement lists, defaults and category tables.

Every table below is data, read by `text`, `categories` and `plans.profiles`. Category tables are
ordered lists of (label, variants); the first matching label wins.
"""

from __future__ import annotations

# Code points that appear when UTF-8 text was decoded as Latin-1.
A_TILDE = "Ã"      # Ã
PLUS_MINUS = "±"   # ±
CENT = "¢"         # ¢
A_CIRC = "â"       # â
N_TILDE = "ñ"      # ñ

# Characters deleted outright.
STRIPPED_CHARS = {
    "datamart": A_TILDE + PLUS_MINUS + CENT,
    "external": A_TILDE + PLUS_MINUS + A_CIRC,
}

# Ordered literal replacements.
REPLACEMENTS = {
    "chunked": [(A_TILDE + PLUS_MINUS, N_TILDE), (A_TILDE + CENT, ""), (A_TILDE, "")],
    "microbatch": [
        (A_TILDE + PLUS_MINUS, N_TILDE),
        ("U" + N_TILDE + "ER0" + A_CIRC + A_CIRC, "USER0"),
        (A_CIRC, ""),
        (A_TILDE, ""),
    ],
    "lines": [(A_TILDE + PLUS_MINUS, N_TILDE), (A_TILDE + CENT, ""), (A_TILDE, "")],
}

# Unicode white space, as trimmed from both ends of a text.
WHITESPACE = "".join(
    map(
        chr,
        [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
         0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)

# What a NULL becomes in the `datamart` profile.
DATAMART_DEFAULTS = {
    "transaction_id": "UNKNOWN",
    "customer_id": "UNKNOWN",
    "customer_segment": "Otros",
    "product_id": "UNKNOWN",
    "product_category": "Otros",
    "product_lifecycle": "Desconocido",
    "currency": "MXN",
    "region": "Centro",
    "warehouse": "UNKNOWN",
    "status": "Pendiente",
    "payment_method": "Otros",
    "notes": "",
    "created_by": "SYSTEM",
}

# Defaults of the other profiles.
DEFAULT_CURRENCY = "MXN"
DEFAULT_REGION = "MEXICO"
MISSING_CATEGORY = "NO_ESPECIFICADO"
UNKNOWN_ID = "UNKNOWN"

# Category tables matched exactly on the lower-cased raw text.
DATAMART_CATEGORIES = {
    "customer_segment": [
        ("Empresarial", ["empresarial", "empresa", "business", "corporate"]),
        ("Individual", ["individual", "persona", "personal", "retail"]),
        ("Gobierno", ["gobierno", "government", "publico", "public"]),
    ],
    "product_category": [
        ("Varilla", ["varilla", "reinforcement", "refuerzo"]),
        ("Alambre", ["alambre", "wire", "cable"]),
        ("Perfil", ["perfil", "profile", "structural"]),
        ("Tubo", ["tubo", "tube", "pipe"]),
    ],
    "product_lifecycle": [
        ("Activo", ["nuevo", "new", "activo", "active"]),
        ("Descontinuado", ["descontinuado", "discontinued", "obsoleto", "obsolete"]),
        ("Transición", ["faseout", "phaseout", "transicion", "transition"]),
    ],
    "currency": [
        ("MXN", ["mxn", "peso", "pesos", "mexico"]),
        ("USD", ["usd", "dolar", "dollars", "usa"]),
        ("EUR", ["eur", "euro", "europe"]),
    ],
    "region": [
        ("Norte", ["norte", "north", "norte de mexico"]),
        ("Centro", ["centro", "center", "centro de mexico"]),
        ("Sur", ["sur", "south", "sur de mexico"]),
        ("Occidente", ["occidente", "west", "occidente de mexico"]),
        ("Oriente", ["oriente", "east", "oriente de mexico"]),
    ],
    "status": [
        ("Completado", ["completado", "completed", "finalizado", "finished"]),
        ("Pendiente", ["pendiente", "pending", "en proceso", "in process"]),
        ("Cancelado", ["cancelado", "cancelled"]),
        ("Devuelto", ["devuelto", "returned", "retorno", "return"]),
    ],
    "payment_method": [
        ("Efectivo", ["efectivo", "cash", "contado"]),
        ("Tarjeta", ["tarjeta", "card", "credito", "credit"]),
        ("Transferencia", ["transferencia", "transfer", "banco", "bank"]),
        ("Cheque", ["cheque", "check"]),
    ],
}

# Category tables matched as substrings of the lower-cased raw text.
EXTERNAL_CATEGORIES = {
    "customer_segment": [
        ("EMPRESARIAL", ["empres", "business"]),
        ("GUBERNAMENTAL", ["gob", "gov"]),
        ("INDIVIDUAL", ["indiv", "personal"]),
        ("MAYORISTA", ["mayor", "wholesale"]),
    ],
    "product_category": [
        ("VARILLA", ["varill", "rebar"]),
        ("ALAMBRE", ["alambr", "wire"]),
        ("PERFIL", ["perfil", "profile"]),
        ("PLACA", ["plac", "plate"]),
        ("TUBO", ["tub", "tube"]),
    ],
    "product_lifecycle": [
        ("NUEVO", ["nuev", "new"]),
        ("MADURO", ["madur", "mature"]),
        ("DECLINANTE", ["declin", "decline"]),
    ],
    "region": [
        ("MEXICO", ["mex", "mx"]),
        ("NORTE", ["norte", "north"]),
        ("SUR", ["sur", "south"]),
        ("ESTE", ["este", "east"]),
        ("OESTE", ["oeste", "west"]),
    ],
    "status": [
        ("COMPLETADO", ["complet", "done"]),
        ("PENDIENTE", ["pend", "pending"]),
        ("CANCELADO", ["cancel"]),
        ("DEVUELTO", ["devuel", "return"]),
    ],
    "payment_method": [
        ("EFECTIVO", ["efectiv", "cash"]),
        ("TARJETA", ["tarjeta", "card"]),
        ("TRANSFERENCIA", ["transfer", "wire"]),
        ("CHEQUE", ["cheque", "check"]),
    ],
}

# Category tables matched as substrings of the trimmed upper-cased raw text.
MICROBATCH_CATEGORIES = {
    "customer_segment": [
        ("EMPRESARIAL", ["EMPRESARIAL", "BUSINESS", "CORPORATE", "EMPRESA"]),
        ("GUBERNAMENTAL", ["GUBERNAMENTAL", "GOVERNMENT", "GUBERNMENTAL"]),
        ("INDIVIDUAL", ["INDIVIDUAL", "PERSONAL", "INDIVIDUO", "CLIENTE"]),
        ("MAYORISTA", ["MAYORISTA", "WHOLESALE", "MAYOREO"]),
    ],
    "product_category": [
        ("VARILLA", ["VARILLA", "REBAR", "VARILLAS"]),
        ("ALAMBRE", ["ALAMBRE", "WIRE", "ALAMBRES"]),
        ("PERFIL", ["PERFIL", "PROFILE", "PERFILES"]),
        ("PLACA", ["PLACA", "PLATE", "PLACAS"]),
        ("TUBO", ["TUBO", "TUBE", "TUBOS"]),
    ],
    "status": [
        ("COMPLETADO", ["COMPLETADO", "COMPLETED", "FINALIZADO", "DONE"]),
        ("PENDIENTE", ["PENDIENTE", "PENDING", "EN_PROCESO"]),
        ("CANCELADO", ["CANCELADO", "CANCELLED", "CANCELED"]),
        ("DEVUELTO", ["DEVUELTO", "RETURNED", "REFUNDED"]),
    ],
}
