"""Fixed values of the domain."""

# The 48 canonical neighbourhoods.
CANON = [
    "Agronomía", "Almagro", "Balvanera", "Barracas", "Belgrano", "Boedo", "Caballito", "Chacarita", "Coghlan", "Colegiales", "Constitución", "Flores",
    "Floresta", "La Boca", "La Paternal", "Liniers", "Mataderos", "Monserrat", "Monte Castro", "Nueva Pompeya", "Núñez", "Palermo", "Parque Avellaneda",
    "Parque Chacabuco", "Parque Chas", "Parque Patricios", "Puerto Madero", "Recoleta", "Retiro", "Saavedra", "San Cristóbal", "San Nicolás", "San Telmo",
    "Vélez Sarsfield", "Versalles", "Villa Crespo", "Villa Devoto", "Villa Gral. Mitre", "Villa Lugano", "Villa Luro", "Villa Ortúzar", "Villa Pueyrredón",
    "Villa Real", "Villa Riachuelo", "Villa Santa Rita", "Villa Soldati", "Villa Urquiza", "Villa del Parque",
]

# Aliases (without accents, lower case) where unknown names are kept.
ALIASES_KEEP = {"velez": "Vélez Sarsfield", "montserrat": "Monserrat", "monserratt": "Monserrat", "paternal": "La Paternal", "villa general mitre": "Villa Gral. Mitre", "villa gral mitre": "Villa Gral. Mitre"}

# Aliases where unknown names become blank; they go before the canonical names.
ALIASES_BLANK = {"boca": "La Boca", "paternal": "La Paternal", "pompeya": "Nueva Pompeya", "villa gral mitre": "Villa General Mitre", "villa general mitre": "Villa Gral. Mitre", "villa sta rita": "Villa Santa Rita"}

# Aliases of the title-case form.
ALIASES_TITLE = {"villa ortuzar": "Villa Ortúzar", "villa ortuzar caba": "Villa Ortúzar", "nunez": "Núñez", "san nicolas": "San Nicolás", "parque chacabuco": "Parque Chacabuco", "balvanera": "Balvanera", "retiro": "Retiro", "villa crespo": "Villa Crespo"}

# Statuses that the base allows.
STATUSES = ["Realizada", "Suspendida", "Reprogramada", "en agenda", "Se modifico el barrio"]

# Columns of the user's table that are never filled.
BLOCKED = ["Día de la semana", "% de Asistencia", "Falta Informacion", "Comuna", "Poblacion", "p. Mujer", "P. Varon", "(km2)", "(hab/km2)", "Zona"]
