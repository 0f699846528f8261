"""Value lists for sender and subject filters."""

# Public mail providers counted as private senders.
PRIVATE_DOMAINS = (
    "eplus.de", "kabelmail.de", "aol.com", "aol.de", "freenet.de", "t-online.de",
    "telekom.de", "arcor.de", "kabel.de", "ionos.de", "gmail.de", "gmail.com",
    "icloud.de", "icloud.com", "gmx.de", "gmx.com", "web.de", "yahoo.de", "yahoo.com",
    "outlook.de", "outlook.com", "mail.de",
)

# Subjects of web-form notices that never enter the corpus.
EXCLUDED_SUBJECTS = (
    "Kontaktanfrage Internet Auftritt Banking",
    "Eingang einer Kontaktanfrage",
)
