"""Term lists and limits of the listing rules."""

from __future__ import annotations

# ---- fixed values: results depend on these exact lists, patterns and limits ----
TRACKING_PREFIXES = ["utm_", "ref", "src", "trk", "gclid", "fbclid"]
NON_JOB_DOMAINS = ["instagram.com", "facebook.com", "twitter.com", "x.com", "youtube.com", "youtu.be", "t.me", "pinterest.com", "quora.com", "reddit.com"]
NON_JOB_LINKS = [
    "instagram.com", "t.me", "telegram.me", "wa.me", "chat.whatsapp.com", "facebook.com", "fb.com", "twitter.com", "x.com/",
    "youtube.com/watch", "youtube.com/@", "youtube.com/channel", "youtu.be", "linkedin.com/in/", "linktr.ee",
]
BOARD_DOMAINS = [
    "boards.greenhouse.io", "jobs.lever.co", "jobs.ashbyhq.com", "naukri.com", "internshala.com", "wellfound.com", "linkedin.com",
    "indeed.com", "ycombinator.com", "cutshort.io", "instahyre.com", "hiringcafe.com",
]
PRIORITY_DOMAINS = ["naukri.com", "linkedin.com", "indeed.com", "internshala.com", "wellfound.com", "cutshort.io", "instahyre.com", "hiringcafe.com"]
COMPANY_SUFFIXES = [
    " pvt ltd", " pvt. ltd.", " private limited", " limited", " llp", " inc.", " inc", " llc", " technologies", " technology",
    " labs", " solutions", " services", " systems", " india", " co.", " ltd",
]
AGGREGATE_MARKERS = ["/search", "/category", "/categories", "/tag", "/tags", "/browse", "/find-jobs", "jobs.html", "careers-at", "jobs-at"]
JOB_URL_PATTERNS = [
    r"/job-listings-[^/?]+", r"/job/[^/?]+", r"/jobs/[^/?]+", r"/jobs/view/[^/?]+", r"/vacancy/[^/?]+", r"/position/[^/?]+",
    r"/internship/[^/?]+", r"/viewjob(?:[/?]|$)", r"/careers/[^/?]+", r"/opportunities/[^/?]+",
]
JOB_TITLE_SIGNALS = [
    "software engineer", "developer", "sde", "frontend", "backend", "full stack", "product engineer", "ai engineer", "ml engineer",
    "genai", "intern", "programmer", "engineer", "walk-in", "walkin", "walk in", "hiring drive", "trainee", "off campus", "off-campus",
]
JOB_LINK_TEXT_SIGNALS = ["apply now", "view details", "software engineer", "developer", "sde"]
JOB_TEXT_SIGNALS = ["requirements", "qualifications", "responsibilities", "experience", "what you'll do", "what you will do", "apply", "skills", "education"]
DETAIL_SIGNALS = ["requirements", "qualifications", "responsibilities", "experience", "apply", "employment type", "role", "what you'll do", "what you will do"]
DETAIL_BAD_SIGNALS = ["search results", "all jobs", "category", "filter by"]
PAGE_BAD_SEGMENTS = ["search", "category", "tag", "blog", "article", "collection", "author", "find-jobs", "browse"]
PAGE_BAD_TITLES = ["search results", "all jobs", "careers at", "jobs at", "open positions", "job openings", "working at"]
ANTI_BOT_SIGNALS = [
    "checking your browser before accessing", "just a moment...", "attention required!", "please verify you are a human",
    "enable javascript and cookies to continue", "are you a robot?", "access denied - error code",
]
NAV_TITLES = [
    "", "close", "menu", "about", "home", "sign in", "sign up", "log in", "login", "contact", "contact us", "careers", "jobs", "blog",
    "help", "faq", "search", "skip to content", "skip to main content", "toggle navigation", "toggle menu", "privacy policy",
    "terms of service", "cookie policy",
]
WALKIN_POSITIVE = ["walk-in", "walk in", "walkin", "hiring drive", "walk-in drive", "offline hiring drive", "offline interview", "direct walk-in", "open interview", "mega walk-in"]
WALKIN_NEGATIVE = ["customer support", "voice process", "non-it operations", "bpo", "technical support", "service desk", "manual testing", "data entry"]
NEIGHBOURHOODS = [
    "pune", "hinjewadi", "kharadi", "hadapsar", "viman nagar", "baner", "wakad", "magarpatta", "kothrud", "pimpri-chinchwad",
    "bengaluru", "bangalore", "koramangala", "whitefield", "electronic city", "indiranagar", "hsr layout", "marathahalli",
    "outer ring road", "manyata tech park",
]
PREFERRED_LOCATIONS = [
    "Pune", "Hinjewadi", "Kharadi", "Hadapsar", "Magarpatta", "Baner", "Wakad", "Viman Nagar", "Kothrud", "Pimpri-Chinchwad",
    "Bengaluru", "Bangalore", "Koramangala", "Whitefield", "Electronic City", "Indiranagar", "HSR Layout",
]
OUTSIDE_LOCATIONS = [
    "united states", "usa", "canada", "uk", "united kingdom", "australia", "germany", "france", "singapore", "dubai", "uae", "europe",
    "hyderabad", "gurugram", "gurgaon", "remote",
]
SENIOR = [
    "senior", "sr.", "staff", "principal", "lead", "tech lead", "team lead", "architect", "manager", "director", "head", "vp",
    "5+ years", "6+ years", "7+ years", "8+ years", "10+ years",
]
FRESHER = [
    "fresher", "freshers", "entry level", "entry-level", "0 year", "0 years", "0-1 year", "0–1 year", "0-2 years", "0–2 years",
    "0-1 yrs", "0-2 yrs", "new grad", "new graduate", "graduate", "graduate engineer", "graduate trainee", "software trainee", "GET",
    "junior", "associate", "campus hire", "campus recruitment", "2027 batch", "2026 batch", "2025 batch", "2024 batch",
    "recent graduate", "immediate joiner", "early career", "trainee engineer",
]
GRADUATE = [
    "new grad", "fresher", "0-1 years", "0-1 yrs", "0-1 yr", "0 to 1", "0-2 years", "0-2 yrs", "0-2 yr", "0 to 2", "0 - 2", "0 – 2",
    "0–1", "0–2", "up to 1 year", "1 year experience", "1+ years", "final-year", "2026 graduate", "graduate", "entry level",
    "entry-level",
]
ROLES = [
    "software engineer", "software development engineer", "software developer", "SDE", "SDE 1", "SDE-1", "SDE I",
    "software development engineer I", "junior software engineer", "associate software engineer", "graduate software engineer",
    "entry level software engineer", "entry-level software engineer", "junior software developer", "graduate software developer",
    "software engineer trainee", "graduate engineer trainee", "GET", "software development engineer trainee", "web developer",
    "full stack developer", "full-stack developer", "full stack engineer", "full-stack engineer", "fullstack developer",
    "fullstack engineer", "MERN developer", "MERN stack developer", "frontend developer", "front-end developer", "frontend engineer",
    "front-end engineer", "React developer", "React.js developer", "React engineer", "Next.js developer", "JavaScript developer",
    "TypeScript developer", "backend developer", "back-end developer", "backend engineer", "back-end engineer", "Node.js developer",
    "Node.js engineer", "API developer", "product engineer", "application developer", "AI engineer", "AI software engineer",
    "AI developer", "generative AI engineer", "LLM engineer", "AI application engineer",
]
CORE_TECH = [
    "react", "react.js", "reactjs", "next.js", "nextjs", "typescript", "javascript", "node", "node.js", "express", "express.js",
    "mern", "mongodb", "mongodb atlas", "postgresql", "sql", "sqlite", "rest api", "rest apis", "api development", "redux",
    "redux toolkit", "zustand", "react query", "tanstack query", "tailwind css", "firebase", "supabase", "docker", "docker compose",
    "git", "github", "mcp", "model context protocol", "llm", "llm apis", "ai engineering", "ai agents", "rag", "generative ai",
    "python", "java",
]
PROFILE = [
    "JavaScript", "TypeScript", "React", "React.js", "Next.js", "Node.js", "Node", "Express", "Express.js", "MongoDB", "MongoDB Atlas",
    "PostgreSQL", "SQL", "SQLite", "REST API", "REST APIs", "API development", "MERN", "full stack", "frontend", "backend", "Redux",
    "Redux Toolkit", "Zustand", "React Query", "TanStack Query", "Tailwind CSS", "Firebase", "Supabase", "Git", "GitHub", "Docker",
    "Docker Compose", "Vercel", "Render", "MCP", "Model Context Protocol", "LLM", "LLM APIs", "AI Engineering", "AI agents",
    "AI infrastructure", "RAG", "generative AI", "OpenAI", "Anthropic", "Claude", "Gemini", "Groq", "OpenRouter", "DeepSeek",
    "Mistral", "SSE", "Server-Sent Events", "Jest", "testing", "system design", "data structures", "algorithms", "DSA", "OOP", "DBMS",
    "operating systems", "JWT", "authentication", "Cloudinary", "Multer", "bcrypt", "async processing",
]
INFRASTRUCTURE = ["error classification", "failover", "provider routing", "token streaming"]
EDUCATION_OPEN = [
    "any engineering branch", "all engineering branches", "any branch", "any degree", "bachelor's degree", "bachelors degree",
    "engineering degree", "technology or engineering", "computer science or related field",
]
PERMANENT_ERRORS = [
    "invalid_response", "invalid json", "invalid schema", "unsupported", "misconfigured", "configuration", "missing api key",
    "invalid api key", "http_400", "http_401", "http_403", "http_404", "http_422", "valueerror", "typeerror", "keyerror", "indexerror",
]
TRANSITIONS = [
    ("QUEUED", "EVALUATING"), ("QUEUED", "DEADLINE_EXCEEDED"),
    ("EVALUATING", "EVALUATED"), ("EVALUATING", "RETRYABLE_ERROR"), ("EVALUATING", "PERMANENT_ERROR"), ("EVALUATING", "DEADLINE_EXCEEDED"),
    ("EVALUATED", "PASSED"), ("EVALUATED", "REJECTED"), ("EVALUATED", "PERMANENT_ERROR"),
    ("RETRYABLE_ERROR", "EVALUATING"), ("RETRYABLE_ERROR", "DEADLINE_EXCEEDED"), ("RETRYABLE_ERROR", "PERMANENT_ERROR"),
    ("DEADLINE_EXCEEDED", "EVALUATING"), ("DEADLINE_EXCEEDED", "PERMANENT_ERROR"),
]
TERMINAL = ["PASSED", "REJECTED", "PERMANENT_ERROR"]
RESUMABLE = ["QUEUED", "RETRYABLE_ERROR", "DEADLINE_EXCEEDED", "EVALUATING"]
LEASE_SECONDS = 3600
STATUS_ALIASES = {"FAILED": "RETRYABLE_ERROR", "UNRESOLVED": "RETRYABLE_ERROR", "RETRY": "RETRYABLE_ERROR", "RETRYABLE": "RETRYABLE_ERROR", "DEADLINE": "DEADLINE_EXCEEDED"}
OUTCOME_GROUPS = {
    "SUCCESS": ["SUCCESS"], "TIMEOUT": ["TIMEOUT", "TIMEOUTING"], "RATE_LIMIT": ["RATE_LIMIT", "RATE_LIMITED", "HTTP_429"],
    "SERVER": ["HTTP_5XX", "SERVER_ERROR"], "INVALID": ["INVALID_JSON", "INVALID_RESPONSE", "INVALID_SCHEMA"],
}
PRIVATE_KEYS = [
    "phone", "pin_code", "full_address", "password", "passwords", "api_key", "api_keys", "token", "tokens", "cookie", "cookies",
    "authentication_secrets", "secrets", "refresh_token", "access_token", "client_secret", "private_key", "resume_pdf",
]
SECRET_PARTS = ["password", "api_key", "token", "cookie", "secret"]
PROFILE_SECTIONS = {
    "Identity & Career Stage": ["identity", "career_stage", "personal_identity"],
    "Contact & Public Profiles": ["contact", "public_profiles", "profiles"],
    "Location & Work Preferences": ["location", "work_preferences", "preferred_locations"],
    "Professional Profile": ["professional_profile", "professional_summary", "professional_identity"],
    "Career Objective": ["career_objective", "career_goals", "objective"],
    "Education": ["education", "academic_background", "academics"],
    "Experience": ["experience", "work_experience", "internships", "employment"],
    "Skills": ["skills", "technical_skills", "technical_profile", "technical_stack", "skillset", "technologies", "tech_stack"],
    "AI Engineering": ["ai_engineering", "ai_capabilities", "ai_skills", "llm_engineering", "verified_ai_engineering"],
    "Projects": ["projects", "project_portfolio", "project_experience", "flagship_projects", "ai_projects", "professional_projects"],
    "Leadership": ["leadership", "leadership_experience", "campus_leadership", "activities"],
    "Achievements": ["achievements", "awards", "honors", "recognition"],
    "Competitive Programming / CP Profile": ["competitive_programming", "competitive_programming_profile", "cp_profile", "programming_profile", "coding_profile", "ds_algorithm_profile", "competitive_programming_data"],
    "Job Preferences": ["job_preferences", "career_preferences", "target_preferences"],
    "Application / Career Content": ["application_content", "application_profile", "application_context", "resume_context"],
    "Cover Letter / Motivation Context": ["cover_letter", "cover_letter_context", "motivation", "motivation_context"],
    "Interview / Personal Positioning": ["about_narrative", "personal_brand", "interview_context", "positioning", "personal_positioning"],
}
PROFILE_MISSING = "No dedicated section was found; consult Additional Master-Profile Data only when relevant."
PROFILE_HEAD = ["CANONICAL CANDIDATE PROFILE — SOURCE OF TRUTH", "Use this profile as the factual authority for matching. Do not invent missing facts."]
PROFILE_SNAPSHOT = "Complete Canonical Profile Snapshot"
PROFILE_SKILLS_FIRST = [
    "React", "React 19", "Next.js 15", "Node.js", "Express.js 4", "TypeScript 5", "MongoDB Atlas", "PostgreSQL", "Prisma", "Docker",
    "MCP (Model Context Protocol)", "JWT (jsonwebtoken)", "Redux Toolkit", "Tailwind CSS 4",
]
PROFILE_HIDDEN_PROJECT = "AI SEO Audit Platform"
PROFILE_MAX = {"projects": 8, "skills": 30, "experiences": 6}
CRAWL_KEYWORDS = [
    "software engineer", "software developer", "sde", "frontend", "backend", "full stack", "product engineer", "ai engineer",
    "ml engineer", "genai", "react", "node", "javascript", "graduate", "fresher", "junior", "intern",
]
CRAWL_WEIGHT, CRAWL_SEEDS, CRAWL_ROWS = 0.8, 28, 1000
SEARCH_CAPS = {"queries": 32, "results": 10, "total": 150, "expansions": 10, "links": 5, "details": 50}
COMPONENT_CAPS = {"role_match": 25, "experience_match": 20, "technical_match": 25, "project_match": 10, "education_match": 10, "location_match": 5, "company_quality": 5}
EMAIL_PATTERN = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
URL_PATTERN = r"""https?://[^\s\)\]\>"']+"""
YEARS_PATTERN = r"\b([2-9]|1[0-9])\+?\s*(?:\+|to|-|–|\s)*\s*(?:years?|yrs?)"
YEARS_PREFERRED = r".{0,30}(?:preferred|a plus|nice to have|advantage|bonus)\b"
CS_ONLY_PATTERN = r"\b(?:computer science|cs|b\.?tech in cs|b\.?tech cs|it|information technology)(?: graduates| candidates| engineers| students)? only\b|\bstrictly (?:computer science|cs|it)\b"
MAX_CANDIDATES, MIN_PER_SOURCE, MIN_SCORE, FIT_THRESHOLD, FRESHNESS_DAYS = 300, 5, 6, 70, 30
# ---- end of fixed values ----
