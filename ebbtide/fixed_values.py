"""Labels, edges, codes and texts that decide the results.

They are kept in one place so that another set can be passed in; every plan takes
them as parameters with these defaults.
"""

from math import inf

# Report bands: half-open [lo, hi), the last one open to the right.
AGE_EDGES = [0, 10, 20, 30, 40, 50, 60, 70, inf]
AGE_LABELS = ["0 a 9", "10 a 19", "20 a 29", "30 a 39", "40 a 49", "50 a 59", "60 a 69", "70+"]
TENURE_EDGES = [0, 7, 13, 25, inf]
TENURE_LABELS = ["1 a 6 meses", "6 a 12 meses", "1 a 2 anos", "2+"]
GRAND_TOTAL = " TOTAL GERAL"

# Churn classes: inclusive upper bounds in months, then everything else.
TENURE_CLASS_BOUNDS = [6, 12, 24, 60, 120, 240]
TENURE_CLASS_LABELS = [
    "1. Até 6 meses",
    "2. 7 meses a 1 ano",
    "3. 13 meses a 2 anos",
    "4. 2 anos e 1 mês a 5 anos",
    "5. 5 anos e 1 mês a 10 anos",
    "6. 10 anos 1 mês a 20 anos",
    "7. Acima de 20 anos",
]
# Churn classes: inclusive age ranges in years, then everything else.
AGE_CLASS_RANGES = [(0, 9), (10, 19), (20, 29), (30, 39), (40, 49), (50, 59), (60, 69)]
AGE_CLASS_LABELS = [
    "01. 0 a 9 anos",
    "02. 10 a 19 anos",
    "03. 20 a 29 anos",
    "04. 30 a 39 anos",
    "05. 40 a 49 anos",
    "06. 50 a 59 anos",
    "07. 60 a 69 anos",
    "08. 70 anos ou mais",
]
ROLLUP_TOTAL = "TOTAL"

# Plan class code to label, by dialect; other codes keep their raw value.
CLASS_LABELS_A = {
    "1": "1 - Classe 1",
    "2": "2 - Classe 2",
    "3": "3 - Classe 3",
    "4": "4 - Classe 4",
    "5": "5 - Classe 5",
    "IND": "Individual",
    "PRE": "Premium",
    "VER": "VIP",
}
CLASS_LABELS_B = {
    "1": "1 *",
    "2": "2 *",
    "3": "3 *",
    "4": "4 *",
    "5": "5 *",
    "IND": "   ",
    "PRE": "* P",
    "VER": "* V",
}

# Plan modality to description. Modality 3 has a special plan code. The product
# names belong to the data owner, so neutral names stand here.
MODALITY_LABELS = {n: f"Modality {n}" for n in (1, 2, 3, 4, 5, 6, 7, 8, 9)}
SPECIAL_PLAN_CODE = "0008"
SPECIAL_PLAN_LABEL = "Modality 3 special"
MODALITY_OTHER = "Outros"

# Filters of the two detail dialects.
EXCLUDED_COMPANY_A = "0003"
MODALITIES_A = [1, 2]
COMPANIES_B = ["0001", "0002", "0003", "0006", "0007"]
EXCLUDED_PLANS_B = ["0083", "0094", "0095", "0096"]

# Month names.
MONTHS = ["jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez"]

# Goal messages.
DASH = "—"
NO_GOAL = "sem meta definida"
GOAL_BEATEN = "✅ Meta batida! Superou em %d vida(s)"
GOAL_MISSING = "faltam %d vidas para alcançar a meta"
BAR_TOP = "🟦"
BAR_MID = "🟩"
BAR_LOW = "🟨"
BAR_EMPTY = "⬜"
TOTAL_TEAM = "TOTAL GERAL"

# Value statistics and KPIs.
STAT_LABELS = ["Valor Médio", "Valor Mediano", "Valor Mínimo", "Valor Máximo"]
REVENUE_LABELS = {"cancelled": "Receita Perdida", "reactivated": "Receita Resgatada"}
KPI_LABELS = {"cancelled": "Total de Cancelamentos", "reactivated": "Total de Reativados"}
KPI_AGE = "Idade Média"
KPI_TENURE = "Tempo Médio"
MONTHLY = " (Mensal)"
YEARS = " anos"

# Leads.
WON_STAGE = "Ganho"
LOST_STAGES = ["Perdido", "Desistiu", "Descartado"]
OPEN_STAGES = ["Prospecção", "Contato Pré Vendas", "Negociação", "Em Aprovação", "Sem contato"]
DAY_PART_EDGES = [-1, 6, 12, 18, 24]
DAY_PART_LABELS = ["madrugada", "manhã", "tarde", "noite"]
CHANNELS = {
    "Tráfego Pago": "trafego_pago",
    "Orgânico": "organico",
    "nenhum": "desconhecido",
    "Offline": "offline",
}
CHANNEL_OTHER = "outro"
PLACE_UNKNOWN = "desconhecida"
TEAM_MARKS = [
    ("Pré-Vendas", "sdr"),
    ("Suporte", "sdr"),
    ("Televendas", "televendas"),
    ("Vendas Diretas", "vendas_diretas"),
]
TEAM_OTHER = "outras"
MISSING_CATEGORY = "nan"
SCORE_EDGES = [0, 25, 50, 75, 101]
SCORE_LABELS = ["Frio (0-25)", "Morno (26-50)", "Quente (51-75)", "Hot (76-100)"]
SCORE_COLOURS = [(76, "#1D9E75"), (51, "#378ADD"), (26, "#EF9F27")]
SCORE_COLOUR_ELSE = "#D85A30"
SCORE_UNIT = " pts"

# Postal codes in mail text.
CODE_WORD = "CEP"
CODE_WINDOW = 50
CODE_CAP = 20
DATE_PREFIXES = ["19", "20", "21"]
SUBJECT_CHARS = 100
