"""Labelled exemplars of residue and of sentences that speak about it.

Kinds: 3 a mention (a window that holds one speaks about residue), 2 a full message, 1 what stands beside a message and is no
residue alone, 0 a filler vocabulary, of which any few words count.
"""

# Wordings of residue.
MESSAGES = [
    "404 Not Found", "403 Forbidden", "429 Too Many Requests", "500 Internal Server Error", "502 Bad Gateway", "503 Service Unavailable", "504 Gateway Timeout",
    "You have no access to this folder", "The request took too long", "Something broke on our side", "The scan you asked for does not exist",
    "Viewer is down for maintenance", "Slow down and try later", "The upstream reader gave no answer", "Page not found", "Access denied", "This site is under construction",
    "Помилка шлюзу", "Сервіс тимчасово недоступний", "Доступ заборонено", "Забагато запитів", "Час очікування вичерпано", "Сторінку не знайдено", "Внутрішня помилка сервера",
    "Страница не найдена", "Доступ запрещён", "Внутренняя ошибка сервера", "Сервис временно недоступен",
    "Тут буде текст", "Текст сторінки з'явиться згодом", "Приклад тексту для заповнення", "Content coming soon", "Sample text goes here", "Placeholder paragraph", "Your text here",
    "Здесь будет текст", "Insert text here",
    "Something went wrong", "An unexpected error occurred", "You don't have permission to access this resource", "The requested URL was not found on this server", "Bad Request", "Internal Server Error",
    "Service Unavailable", "The page you are looking for could not be found", "This page isn't available", "Your session has expired", "The site is temporarily down for maintenance", "Connection timed out",
    "JavaScript must be enabled", "JavaScript is disabled in your browser", "JavaScript is required", "This site requires JavaScript", "Cookies must be enabled",
    "Під час обробки запиту сталася помилка", "Щось пішло не так", "Сталася неочікувана помилка", "Сайт на технічному обслуговуванні", "Ваша сесія завершилася", "Запитану сторінку не знайдено", "Немає доступу до цього ресурсу",
    "Что-то пошло не так", "Произошла непредвиденная ошибка", "Сайт на техническом обслуживании", "Запрашиваемая страница не найдена",
    "Text goes here", "Add your text here", "Click to edit this text", "Заголовок сторінки тут", "Вставте текст сюди", "Введите текст здесь",
]
OPENINGS = ["Please enable", "You need to enable", "Turn on", "This viewer requires", "Увімкніть", "Включите", "Ваш браузер не підтримує", "Для перегляду сканів потрібен", "Your browser does not support"]
SCRIPTS = ["JavaScript", "java script", "JS", "scripts", "скрипти", "скрипты"]
#: What stands beside a message and is no residue alone.
COMPANIONS = [
    "and reload the page", "to view this page", "щоб побачити сторінку", "у налаштуваннях", "і оновіть сторінку", "in your browser",
    "Error 500", "HTTP 500", "Помилка 500", "Ошибка 500", "Request id 0", "viewer 1 0", "Go back to the start page",
    "Спробуйте пізніше або поверніться на головну", "Зверніться до адміністратора архіву", "Try again later", "Please try again", "Будь ласка спробуйте ще раз", "Попробуйте позже", "to use this site", "Contact the administrator",
]
FILLERS = [
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat",
    "asdf qwer zxcv йцук фіва фыва xxx test тест",
]
MENTIONS = [
    "template field", "template fields", "template placeholder", "template keeps", "placeholder is replaced", "placeholder stands for", "field is replaced by", "guide explains",
    "полів шаблону", "полі шаблону", "поле шаблону", "поля шаблону", "шаблон поле", "замінюється назвою", "замінюється числом", "полей шаблона", "поле шаблона", "заменяется названием",
    "message means", "message appears", "error means", "notice means", "повідомлення означає", "помилка означає", "сообщение означает",
]


def labelled() -> list[tuple[int, str]]:
    """(kind, text) of all exemplars."""
    notices = [f"{o} {s}" for o in OPENINGS for s in SCRIPTS]
    return [(k, t) for k, texts in ((2, MESSAGES + notices), (1, COMPANIONS), (0, FILLERS), (3, MENTIONS)) for t in texts]
