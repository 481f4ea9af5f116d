"""Word lists and weights that decide results."""

# Heading aliases of the section splitter and what each names.
SECTION_ALIASES = {
    "header": "Header", "contact": "Header", "personal information": "Header",
    "summary": "Summary", "profile": "Summary", "professional summary": "Summary", "objective": "Summary", "about me": "Summary",
    "experience": "Experience", "work experience": "Experience", "professional experience": "Experience", "employment": "Experience", "career history": "Experience",
    "skills": "Skills", "technical skills": "Skills", "core competencies": "Skills", "competencies": "Skills", "tech stack": "Skills", "technologies": "Skills",
    "projects": "Projects", "personal projects": "Projects", "academic projects": "Projects", "selected projects": "Projects", "relevant projects": "Projects",
    "education": "Education", "academic background": "Education", "qualifications": "Education", "education and training": "Education", "education and qualifications": "Education",
    "certifications": "Certifications", "certificates": "Certifications", "licenses": "Certifications", "credentials": "Certifications",
    "certifications and courses": "Courses", "certifications & courses": "Courses", "courses": "Courses", "training": "Courses", "trainings": "Courses", "workshops": "Courses",
    "achievements": "Achievements", "accomplishments": "Achievements", "awards": "Achievements", "honors": "Achievements",
    "languages": "Languages", "language proficiency": "Languages",
    "additional information": "Additional Information", "additional info": "Additional Information", "interests": "Additional Information", "activities": "Additional Information", "extracurricular activities": "Additional Information", "volunteer work": "Additional Information",
    "education & certifications": "Education", "education and certifications": "Education",
    "technical experience & training": "Experience", "technical experience and training": "Experience",
    "notable impact & achievements": "Achievements", "notable impact and achievements": "Achievements",
}
# Aliases that only the splitter knows; candidate extraction lacks them.
COMPOSITE_ALIASES = (
    "education & certifications", "education and certifications",
    "technical experience & training", "technical experience and training",
    "notable impact & achievements", "notable impact and achievements",
)
# Canonical sections, in order.
CANONICAL_SECTIONS = ("Header", "Summary", "Experience", "Skills", "Projects", "Education", "Certifications", "Courses", "Achievements", "Languages", "Additional Information")
CONTRACT_VERSION = "phase2-input-v1"

# Headings that the block classifier knows.
LABEL_HEADINGS = (
    "summary", "profile", "objective", "experience", "work experience", "employment", "professional experience", "education", "projects",
    "technical skills", "skills", "certifications", "languages", "training", "courses", "activities", "achievements",
)
# Headings that block merging stops at.
MERGE_HEADINGS = (
    "header", "contact", "personal information", "summary", "profile", "professional summary", "objective", "about me",
    "experience", "work experience", "employment", "professional experience", "career history",
    "education", "academic background", "qualifications", "education and training", "education and qualifications", "projects",
    "technical skills", "skills", "core competencies", "competencies", "tech stack", "technologies",
    "certifications", "certificates", "licenses", "credentials", "languages", "training", "trainings", "courses",
    "activities", "achievements", "additional information", "additional info", "interests", "extracurricular activities", "volunteer work",
)
# Short capitals that are no headings.
NOT_HEADINGS = ("gpa", "nti")

# Bullet marks at the start of a line.
BULLETS = ("•", "-", "*", "▪", "◦", "–")

# Patterns of dates, places and contacts.
DATE_WORD = r"\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|sept|oct|nov|dec|present|current|\d{4})\b"
PLACE_WORD = r"\b(?:remote|hybrid|onsite|cairo|giza|alexandria|egypt|ksa|saudi|dubai|uae|riyadh|jeddah)\b"
EMAIL = r"[\w.\-+%]+@[\w.\-]+\.[A-Za-z]{2,}"
PHONE = r"(\+?\d[\d\s().-]{7,}\d)"
URL_WORD = r"\b(?:linkedin|github|portfolio|www\.|https?://)"
NOISE = r"[|_~`^<>\[\]{}]"
SPLIT_BLEED = r"\b(?:education|certifications|technical skills|skills|languages|courses|experience|projects|achievements|summary)\s*&\s*$"
REPORT_BLEED = r"(?:^|\s)(?:EDUCATION|CERTIFICATIONS|TECHNICAL SKILLS|SKILLS|LANGUAGES|COURSES|EXPERIENCE|PROJECTS|ACHIEVEMENTS)\s*&\s*$"

# Parts of composite headings.
COMPOSITE_PARTS = ("education", "certifications", "courses", "training", "trainings", "skills", "languages", "experience", "projects", "achievements", "awards", "activities", "information", "summary")

# Points that an audit takes off by severity.
SEVERITY = {"critical": 50, "high": 25, "medium": 12, "low": 5}

# Labels that are no values of lists.
SECTION_LABELS = (
    "languages", "language", "skills", "technical skills", "technical skill", "core competencies", "competencies", "technologies",
    "certificates", "certifications", "training", "trainings", "courses", "projects", "experience", "education", "summary", "profile",
    "background", "volunteering", "technical concepts",
)
# Soft skills by themselves.
COMMON_SOFT_SKILLS = (
    "teamwork", "leadership", "time management", "communication", "public speaking", "analytical thinking", "team player", "detail oriented",
    "critical thinking", "interpersonal intelligence", "problem solving", "problem-solving and critical thinking",
    "communication and presentation skills", "team collaboration and leadership", "networking fundamentals",
)
# Labels before a soft skill's description.
SOFT_SKILL_LABELS = (
    "technical problem solving", "collaborative development", "continuous learning", "personal traits", "communication", "leadership",
    "teamwork", "problem solving", "problem-solving", "adaptability", "critical thinking", "time management",
)
# Labels before a group of skills.
SKILL_WRAPPERS = (
    "backend", "programming languages", "frontend development", "backend development", "databases", "testing & tools", "testing and tools",
    "cloud & devops", "cloud and devops", "concepts", "web", "web development", "mobile", "tools", "tools & practices", "developer tools",
    "version control", "soft skills", "spoken languages", "core cs", "backend technologies", "frameworks & libraries", "languages & frameworks",
    "software design", "state management", "networking", "testing", "problem solving", "data analysis tools", "cumulative gpa",
    "ai & machine learning", "ci/cd & deployment", "testing/devops", "engineering & it", "ai & automation", "sales & communication",
    "digital finance & marketing",
)
# Fragments that are no skills.
SKILL_FRAGMENTS = ("technical concepts", "technologies", "directory", "adaptability")
SKILL_GROUP_WORDS = ("technologies", "technology", "tools", "backend", "frontend", "frameworks", "framework", "languages", "skills")
SKILL_OPENERS = ("and ", "with ", "on ", "using ", "maintaining ", "best practices", "worked on ")
SKILL_FOREIGN = ("soft skills", "languages", "certificates", "certifications", "volunteering")
# Words of technical skills.
TECHNICAL_WORDS = (
    "api", "asp", "architecture", "algorithm", "android", "ansible", "authentication", "aws", "azure", "c#", "c++", "cloud", "compiler", "css",
    "database", "debugging", "devops", "dhcp", "dns", "docker", "entity framework", "express", "fastapi", "figma", "firebase", "flutter",
    "framework", "git", "github", "hibernate", "html", "java", "javascript", "jira", "jwt", "keras", "kotlin", "kubernetes", "langchain",
    "laravel", "linux", "machine learning", "microservices", "mongodb", "mysql", "net", "network", "next.js", "node", "oauth", "oracle",
    "phpunit", "postman", "postgresql", "problem solving", "python", "pytorch", "rabbitmq", "react", "redis", "rest", "scikit", "selenium",
    "server", "signalr", "sql", "spring", "stateful widget", "subnetting", "tailwind", "tensorflow", "terraform", "testing", "typescript",
    "unit testing", "visual studio", "widget", "windows", "yolo",
)
# Words that are no languages.
NOT_LANGUAGES = ("python", "java", "javascript", "react", "node", "sql", "docker", "git")
# Words of certifications, and of what is none.
CERTIFICATION_WORDS = ("certificate", "certification", "certified", "academy", "ccna", "aws", "comptia", "cisco", "license", "credential", "route acadmey", "route academy")
CERTIFICATION_NAMES = ("ccna", "aws saa", "aws", "comptia", "pmp", "ielts", "toefl")
AWARD_WORDS = ("award", "awards", "ranked ", "scholarship", "competition")
NOT_CERTIFICATIONS = (
    "extra-curricular", "extra curricular", "worked on", "identify ", "understand ", "and folders using", "networks", "contributed to",
    "automated ", "improving efficiency", "solution aimed",
)

# Spellings of skills that count as one, replaced in this order.
SKILL_SPELLINGS = (
    ("environment configuration & deployment support", "deployment support"), ("java script", "javascript"), ("type script", "typescript"),
    ("fast api", "fastapi"), ("react.js", "react"), ("node.js", "node"), ("sqlserver", "sql server"), ("asp.net", "aspdotnet"), (".net", "dotnet"),
)
SKILL_NOTES = ("(unit testing)", "(saa-c03 certified)", "(certified)")

# Words that class a supplemental chunk, for recovery; the first class that has one wins.
SUPPLEMENTAL = {
    "publications": ("publication", "paper", "journal", "conference", "peer-reviewed", "accepted at"),
    "awards": (
        "award", "awarded", "honor", "honour", "scholarship", "finalist", "ranked", "runner-up", "1st", "2nd", "3rd",
        "first place", "second place", "third place", "competition", "championship", "hackathon",
    ),
    "activities": (
        "activity", "activities", "extracurricular", "committee", "org team", "technical committee", "pavilion", "exhibition", "ushered",
        "member in org team", "member of", "helped lead", "responsible for data entry",
    ),
    "achievements": (
        "achievement", "accomplishment", "founded", "founded and led", "led a volunteer team", "organized", "represented", "member",
        "participated", "initiative",
    ),
}
SUPPLEMENTAL_EDUCATION = ("publication", "thesis", "bachelor thesis", "capstone")

# Language names of candidate extraction.
LANGUAGE_NAMES = ("english", "arabic", "french", "german", "spanish", "italian", "turkish", "chinese", "japanese", "russian")
# Patterns of candidate extraction.
LINKEDIN_URL = r"\b(?:https?://)?(?:www\.)?linkedin\.com/[^\s|,]+"
GITHUB_URL = r"\b(?:https?://)?(?:www\.)?github\.com/[^\s|,]+"
DATE_HINT = r"\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|sept|oct|nov|dec|\d{1,2}/\d{4}|\d{4}|present|current)\b"
ADAPTER_PREFIX = r"^(?:awards?|achievements?|accomplishments?|honors?|honours?|publications?|activities|volunteer(?:ing| work)?)\s*:\s*"
RECOVERY_PREFIX = r"^(?:awards?|achievements?|accomplishments?|honors?|honours?|publications?|activities|volunteer(?:ing| work)?|awards/activities)\s*:\s*"
CHUNK_BLEED = r"\s+(?:EDUCATION|CERTIFICATIONS|TECHNICAL SKILLS|SKILLS|LANGUAGES|COURSES|EXPERIENCE|PROJECTS)\s*&\s*$"
VOLUNTEERING = r"\b(?:volunteering|volunteer(?:ing)? activities?)\b\s*(.*)$"
DATED_LINE = r"^(?:[A-Z]+\s+\d{4}|\d{4}|[A-Z][A-Za-z]+\s+\d{4}|[A-Z][A-Za-z]+\s+\d{4}\s*,)"
# Places of contact candidates, words of skills that are none, and openers of dense skill blocks.
CONTACT_PLACES = ("cairo", "giza", "egypt", "alexandria", "remote", "new cairo")
NO_SKILL_WORDS = ("certification", "certificate", "course", "bootcamp", "workshop", "udemy", "comptia", "ccna", "saa-c03")
DENSE_SKILL_OPENERS = ("programming", "frontend", "backend", "tools", "concepts", "technical skills")
TRAINING_WORDS = ("bootcamp", "course", "training", "workshop")
TRAINING_LABELS = ("certifications:", "courses:", "training:", "trainings:", "workshops:")
# First lines of project sections that are no projects.
NO_PROJECTS = ("engineering practices", "professional highlights")
NO_PROJECT_WORDS = ("practices", "methodology", "scrum-based development")

# Patterns of grouped entries.
ENTRY_DATE = r"(?:\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|sept|oct|nov|dec)[a-z]*\b[^,\n|]{0,20}\d{4}|\b\d{1,2}/\d{4}\b(?:\s*[-–]\s*(?:present|\d{1,2}/\d{4}))?|\b\d{4}\b(?:\s*[-–]\s*(?:present|\d{4}))?)"
DEGREE = r"\b(?:bachelor|master|bsc|msc|phd|diploma|associate)[^|\n.]*"
INSTITUTION = r"\b([A-Z][A-Za-z&.'\- ]{2,}(?:University|College|Institute|School))\b"
GPA = r"\bGPA[:\s]+([0-9.]+)"
PROJECT_GRADES = (
    r"\b(?:graduation\s+project|capstone\s+project|final\s+project)\s+grade\b[:\s-]*\(?([A-F][+-]?)\)?",
    r"\bproject\s+grade\b[:\s-]*\(?([A-F][+-]?)\)?",
)
SPECIALIZATION = r"\bSpecialization(?: in)?[:\s]+([^|.\n]+)"
# Keys of an entry by meaning, and the keys of an entry where no evidence shows any.
ENTRY_KEYS = {
    "experience": {"primary": ("title", "job_title", "role", "position"), "secondary": ("company_name", "company", "organization", "employer"), "date": ("duration", "date_range", "dates"), "description": ("description", "summary", "details")},
    "projects": {"primary": ("project_name", "name", "title"), "secondary": (), "date": ("duration", "date_range", "dates"), "description": ("description", "summary", "details")},
    "education": {"primary": ("degree", "qualification"), "secondary": ("university_name", "institution", "school", "college"), "date": ("graduation_date", "date_range", "duration"), "description": ()},
    "trainings_courses": {"primary": ("title", "name", "course_name", "training_name"), "secondary": ("institution", "provider", "issuer"), "date": ("duration", "date_range", "dates"), "description": ("description", "summary", "details")},
}
DEFAULT_KEYS = {
    "experience": ("company_name", "title", "duration", "description"),
    "projects": ("project_name", "description", "tools", "duration", "link"),
    "education": ("university_name", "degree", "specialization", "graduation_date", "graduation_status", "GPA", "coursework"),
    "trainings_courses": ("institution", "title", "description"),
}
LIST_KEYS = ("tools", "coursework")
TECHNOLOGY_KEYS = ("tools", "technologies", "tech_stack")
# A certification's tail that is cut, and date ranges.
CERTIFICATION_VERBS = r"\b(completed|identify|understand|worked on|contributed to|automated)\b.*$"
_MONTH = r"(jan|feb|mar|apr|may|jun|jul|aug|sep|sept|oct|nov|dec)"
CERTIFICATION_DATES = rf"\s+\b{_MONTH}[a-z]*\s*\d{{4}}\s*[-–]\s*\b{_MONTH}[a-z]*\s*\d{{4}}\b.*$"
CERTIFICATION_KEY_DATES = rf"\b{_MONTH}[a-z]*\s+\d{{4}}\s*[-–]?\s*{_MONTH}?[a-z]*\s*\d{{0,4}}"
CERTIFICATION_DATED = r"\b(jan|feb|mar|apr|may|jun|jul|aug|sep|sept|oct|nov|dec|\d{4})\b"
# Fields of the coverage report.
COVERAGE_FIELDS = ("technical_skills", "languages", "certifications", "experience", "projects", "education", "trainings_courses", "linkedin", "github")
