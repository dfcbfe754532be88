"""Texts, names and thresholds that results are compared on."""

# --- Business rules -------------------------------------------------------
BONUS_RATE = "0.05"
MIN_ACTIVITIES = 15
WELLBEING_DAYS = 5
WINDOW_MONTHS = 12

# Declared commute mode -> (travel mode, longest accepted distance in km).
COMMUTE_RULES = {
    "Marche/running": ("WALK", "15.00"),
    "Vélo/Trottinette/Autres": ("BICYCLE", "25.00"),
}

# --- Sports for which a rule exists ---------------------------------------
KNOWN_SPORTS = (
    "Running",
    "Randonnée",
    "Tennis",
    "Natation",
    "Football",
    "Rugby",
    "Badminton",
    "Voile",
    "Boxe",
    "Judo",
    "Escalade",
    "Triathlon",
    "Équitation",
    "Tennis de table",
    "Basketball",
)

# --- Input file headers and corrections -----------------------------------
AUDITED_HR_COLUMNS = ("BU", "Type de contrat", "Moyen de déplacement")
AUDITED_SPORT_COLUMNS = ("Pratique d'un sport",)
HR_HEADERS = {
    "ID salarié": "employee_id",
    "Nom": "last_name",
    "Prénom": "first_name",
    "Date de naissance": "birth_date",
    "BU": "business_unit",
    "Date d'embauche": "hire_date",
    "Salaire brut": "gross_salary",
    "Type de contrat": "contract_type",
    "Nombre de jours de CP": "paid_leave_days",
    "Adresse du domicile": "home_address",
    "Moyen de déplacement": "commute_mode",
}
SPORT_HEADERS = {
    "ID salarié": "employee_id",
    "Pratique d'un sport": "sport_type",
}
SPORT_CORRECTIONS = {"Runing": "Running"}

# --- Texts ----------------------------------------------------------------
REASON_VALID = "Distance inférieure ou égale au seuil de %s km."
REASON_INVALID = "Distance supérieure au seuil de %s km."
DURATION_UNKNOWN = "durée inconnue"
DISTANCE_MISSING = "Distance non renseignée"
DISTANCE_INVALID = "Distance invalide"
MESSAGE_START = "Bravo %s %s ! Tu viens de terminer une activité %s"
MESSAGE_DISTANCE = " de %s"
MESSAGE_DURATION = " en %s ! 🔥🏅"
MESSAGE_COMMENT = "\n💬 %s"
DISPLAY_TIMESTAMP = "dd/MM/yyyy HH:mm:ss"

# --- Change data ----------------------------------------------------------
OP_CREATE = "c"
OP_UPDATE = "u"
OP_SNAPSHOT = "r"
OP_DELETE = "d"
