"""Fixed values.

These must equal the values of the system whose results we reproduce; they are
stated here plainly, in their natural order, and imported everywhere else.
"""

# --- card names -------------------------------------------------------------
# Rebalanced card names carry this prefix; it is stripped for statistics.
REBALANCED_PREFIX = "A-"
# Separator between partner commanders in a commander string.
PARTNER_SEPARATOR = "[and]"
# Separator between the faces of a multi-face card name.
FACE_SEPARATOR = " // "

# --- ownership ----------------------------------------------------------------
# Collection entries that count as always owned when checking buildable decks.
BUILDABLE_UNLIMITED = ["Snow-Covered%"]
# The same for the build-progress report.
PROGRESS_UNLIMITED = ["Snow-Covered%", "Forest", "Swamp", "Island", "Plains", "Mountain", "Wastes"]
# Copies assumed for an unlimited entry.
UNLIMITED_COPIES = 99

# --- leaderboards -------------------------------------------------------------
# Card names left out of the top-cards leaderboard.
LEADERBOARD_SKIP_NAMES = ["Plains", "Island", "Swamp", "Mountain", "Forest",
                          "Snow-Covered Plains", "Snow-Covered Island", "Snow-Covered Swamp",
                          "Snow-Covered Mountain", "Snow-Covered Forest"]
# Pattern on the lower-cased type line that marks lands.
LAND_TYPE_PATTERN = "%land%"
# Leaderboard length.
TOP_CARDS = 200

# --- decks ---------------------------------------------------------------------
# Board JSON columns of a landed deck, in landing order.
BOARDS = ["mainboard", "sideboard", "maybeboard", "commanders", "companions", "signatureSpells",
          "attractions", "stickers", "contraptions", "planes", "schemes", "tokens"]
# Object-valued deck fields landed as JSON text.
JSON_FIELDS = ["createdByUser", "colorPercentages", "colorIdentityPercentages", "hubs"]
# Board JSON column -> board type label of a decklist row.
BOARD_TYPES = {"commanders": "Commander", "mainboard": "Mainboard", "companions": "Companion"}
# A priced card line outside [0, MAX_LINE_COST] counts as 0.
MAX_LINE_COST = 9999

# --- prices ----------------------------------------------------------------------
# Fields of a card's price object.
PRICE_FIELDS = ["usd", "usd_foil", "usd_etched", "eur", "eur_foil", "tix"]
# Bounds reported when a currency has no price at all.
NO_PRICE_LOW = 999999999
NO_PRICE_HIGH = -999999999

# --- images ------------------------------------------------------------------------
# Printings of these layouts are skipped.
SKIP_LAYOUTS = ["art_series"]
# Only printings in this language are used.
IMAGE_LANG = "en"
# URL fragment of a front-face image.
FRONT_FACE_MARK = "/normal/front/"

# --- combos ---------------------------------------------------------------------------
# Combo attributes carried as JSON text, in output order.
COMBO_ATTRIBUTES = ["uses", "requires", "produces", "of", "includes", "identity", "manaNeeded",
                    "manaValueNeeded", "otherPrerequisites", "description", "notes", "popularity",
                    "spoiler", "legalities", "prices"]
