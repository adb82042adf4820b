from vacantis.llm import boilerplate

CONTENT = ["A Town Planner is wanted from March on; the first task is a set of schools in Goa.", "• Check joints on site against the approved drawings.", "Tools: Rhino | Enscape | hand drawing", "The role also covers the cookie factory and its privacy screens.", "Compensation: {{salary}} per month.", "Interviews take place in Goa on the"]
CHROME = ["Home > Careers > Town Planner", "We use cookies to improve your visit. Accept all · Manage choices", "Facade Engineer – Anjurli", "© 2025 Acme Studio. All rights reserved.", "Back to top ↑", "Share this opening: Mail / Copy link / Print", "About  Press  Clients  People", "Similar jobs", "Acme Studio – Goa – Tel. +91 00000 10000"]


def test_lines_of_a_page(spark):
    lines = [CHROME[0], "", CONTENT[0], CONTENT[1], CHROME[1], CONTENT[2], "   ", CONTENT[3], CONTENT[4], *CHROME[2:], CONTENT[5]]
    page = "\n".join(lines)
    df = spark.createDataFrame([(1, page, 0), (2, page, 0), (3, "Home > Careers", 0), (4, None, 0), (5, "", 0), (6, "\n\n", 0), (7, page + "\n" + "We draw well. " * 20_000, 0)], "id long, text string, row int")
    got = {}
    for r in boilerplate.boilerplate_lines(df, "id", "text").collect():
        got.setdefault(r["row"], set()).add(r["line_no"])
    want = {i for i, line in enumerate(lines, 1) if line in CHROME}
    assert got == {1: want, 2: want, 7: want}
    main = {r["row"]: r["main"] for r in boilerplate.main_text(df, "id", "text").collect()}
    assert main[1].split("\n") == [x for x in lines if x not in CHROME]
    assert main[3] == "Home > Careers" and main[4] is None and main[5] == ""


def test_empty(spark):
    df = spark.createDataFrame([], "id long, text string")
    assert boilerplate.boilerplate_lines(df, "id", "text").count() == 0


def test_wording_alone_does_not_make_a_line_furniture(spark):
    mail = "Subscribe to our newsletter. Enter your e-mail and press Join."
    pages = [(i, f"{mail}\nWe draw the house number {i} with care, and build it.") for i in range(300)]
    pages.append((900, f"Prepare our newsletter each month, with care for its pictures.\n{mail}"))
    got = {(r["row"], r["line_no"]) for r in boilerplate.boilerplate_lines(spark.createDataFrame(pages, "id long, text string"), "id", "text").collect()}
    assert got == {(i, 1) for i in range(300)} | {(900, 2)}


def test_lines_in_a_wrong_encoding_are_read_as_meant(spark):
    page = "The cafÃ© project covers 90 mÂ² and uses bambooâ€¦\nÂ© 2026 Acme Studio. All rights reserved."
    got = {r["line_no"] for r in boilerplate.boilerplate_lines(spark.createDataFrame([(1, page)], "id long, text string"), "id", "text").collect()}
    assert got == {2}
