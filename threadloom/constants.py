"""Fixed values. They decide results (labels, canned texts, limits), so they must stay as they are."""

# --- Fixed values: intent names ------------------------------------------------------------
INTENTS = (
    "technical_issue",
    "account_access",
    "billing_purchase",
    "how_to",
    "service_status",
    "feedback_complaint",
    "other",
)
FALLBACK_INTENT = "other"

# --- Fixed values: spellings ---------------------------------------------------------------
MISSING_SPELLINGS = ("", "nan", "None", "NaN")
TRUE_FLAGS = ("true", "1", "yes")
INTENT_KEYS = ("category", "intent", "value")

# --- Fixed values: limits ------------------------------------------------------------------
ASCII_SHARE = 0.8
DEDUP_PREFIX = 80
REPLY_LIMIT = 300
REPLY_CUT = 280
CONTEXT_TURNS = 6
NEIGHBOUR_COUNT = 3
SEED = 42
THREAD_SAMPLE = 5000
GOLDEN_SAMPLE = 200
JUDGE_SAMPLE = 50
MIN_AGREEMENT_PAIRS = 5
TOP_FAILURES = 5
DIMENSIONS = ("helpfulness", "tone", "groundedness")

# --- Fixed values: canned texts ------------------------------------------------------------
REPLY_ON_ERROR = "We'd like to help! Please DM us with more details so we can look into this for you."
ESCALATION_ERROR_REASON = "Error in classification — defaulting to escalation."
TRIVIAL_INTENT = "technical_issue"
TRIVIAL_REPLY = "We'd like to help! Please send us a DM with more details so we can assist you further."
TRIVIAL_REASON = "Trivial baseline always escalates."
SINGLE_PROMPT_REPLY = "Please DM us for help."

# --- Default taxonomy texts (user data: pass another taxonomy to the prompt builder) ---------
TAXONOMY = {
    "technical_issue": ("A device or program does not work as it should.", ["The app closes by itself", "Sync stopped"]),
    "account_access": ("Sign-in, password or verification trouble.", ["I am locked out", "Reset code never comes"]),
    "billing_purchase": ("Payments, refunds, subscriptions and warranty.", ["Charged two times", "Stop my plan"]),
    "how_to": ("Asks how to use or set up something.", ["How do I turn this on?", "How to move my photos"]),
    "service_status": ("Asks about an order, a repair or an outage.", ["Is it down?", "Where is my order?"]),
    "feedback_complaint": ("Opinion or anger without a concrete fault.", ["Worst service", "Still waiting"]),
    "other": ("Anything else.", ["Thank you!", "Do you ship abroad?"]),
}
ESCALATION_RULES = (
    "Hand over to a person when the customer is very angry, asks for a person, shares sensitive data, "
    "needs an account change, has a many-sided problem, or was not helped before."
)

# --- Default prompt templates (user data) ---------------------------------------------------
PROMPTS = {
    "intent": (
        "Choose one intent for the message.\n{intent_list}\nMessage: \"{customer_query}\"\n"
        "Answer as JSON with the keys intent and confidence."
    ),
    "reply": (
        "Write a short reply to the customer, grounded in the examples.\nIntent: {intent}\n"
        "Message: \"{customer_query}\"\nExamples:\n{context}\nReply text only."
    ),
    "escalation": (
        "{rules}\nIntent: {intent}\nMessage: \"{customer_query}\"\n"
        "Answer as JSON with the keys escalate and reason."
    ),
    "label": (
        "Label the message.\nMessage: \"{customer_query}\"\nActual reply: \"{brand_response_actual}\"\n{intent_list}\n"
        "{rules}\nAnswer as JSON with the keys intent, escalate and escalation_reason."
    ),
    "single_prompt": (
        "Message: \"{customer_query}\"\nIntents: {intent_names}\n"
        "Answer as JSON with the keys intent, reply, escalate and escalation_reason."
    ),
    "judge": (
        "Rate the reply from 1 to 5 for helpfulness, tone and groundedness.\nMessage: \"{customer_query}\"\n"
        "Reply: \"{reply}\"\nActual reply: \"{brand_response_actual}\"\n"
        "Answer as JSON with the keys helpfulness, tone, groundedness, overall and reasoning."
    ),
}

# --- Fixed values: failure hypotheses by (predicted, actual) intent --------------------------
FAILURE_HYPOTHESES = {
    ("how_to", "technical_issue"): "The query asks *how to fix* a bug, mixing instructional language with a genuine defect report. The classifier latches on to the how-to framing ('how do I...', 'when will ... be fixed') rather than recognising the underlying technical fault.",
    ("technical_issue", "feedback_complaint"): "The user vents frustration about a known issue. The presence of technical language ('restarting', 'text alerts') biases the classifier toward technical_issue, but the core intent is to complain, not to seek a fix.",
    ("feedback_complaint", "technical_issue"): "The query uses strongly emotional language ('y'all need to get this together!') which triggers the feedback/complaint signal, but the user is actually describing a concrete keyboard bug — a technical issue.",
    ("feedback_complaint", "other"): "The query mentions a scam/phishing concern — an 'other' category edge case. The confused/alarmed tone reads as a complaint to the model.",
}
HYPOTHESIS_DEFAULT = (
    "Boundary case between '", "' and '",
    "' — short Twitter messages lack the context needed for reliable classification.",
)
