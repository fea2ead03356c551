"""Small league documents that hold the edge cases, written as landed files."""

from __future__ import annotations

import json
import os

SEASONS = [{"id": 489, "label": "2022/23"}, {"id": 578, "label": "2023/24"}]


def club(i, **extra):
    return {
        "id": float(i),
        "name": f"Club {i}",
        "club": {"name": f"Club {i}", "shortName": f"C{i}", "abbr": f"C{i:02d}"},
        **extra,
    }


def ground(i):
    return {
        "id": float(i), "name": f"Ground {i}", "capacity": 1000.0 * i, "city": "Town",
        "location": {"latitude": 51.5, "longitude": -0.1},
    }


def club_stat(name, club_id, value, grounds):
    owner = {"grounds": [{"id": float(g)} for g in grounds]}
    if club_id is not None:
        owner["club"] = {"id": float(club_id)}
    return {"entity": name, "stats": [{"name": name, "value": value, "owner": owner}]}


CLUB_INFO = [club(1, grounds=[ground(10), ground(11)]), club(2, grounds=[]), club(3)]
CLUB_STATS = [
    club_stat("wins", 1, 5.0, [10, 11]),
    club_stat("wins", 1, 2.0, [10]),
    club_stat("losses", 2, 4.0, [20]),
    club_stat("wins", 3, 1.0, [30]),
    club_stat("wins", None, 9.0, [40]),
]


def person(first, last, dob=None):
    body = {"name": {"first": first, "last": last}}
    if dob:
        body["birth"] = {"date": {"label": dob}}
    return body


COUNTRY = {"isoCode": "GB-ENG", "country": "England", "demonym": "English"}

MANAGERS = [
    {"officialId": 7.0, "currentTeam": {"id": 1.0}, "name": {"first": "Ann", "last": "A"},
     "birth": {"date": {"label": "31 March 1970"}, "country": COUNTRY}},
    {"officialId": 8.0, "currentTeam": {"id": 1.0}, "name": {"first": "Bob", "last": "B"},
     "birth": {"date": {"label": "1 May 1975"}, "country": {"isoCode": "ES", "country": "Spain"}}},
    {"officialId": 9.0, "currentTeam": {"id": 2.0}, "name": {"first": "Cid", "last": "C"}},
    {"officialId": 10.0, "name": {"first": "Dee", "last": "D"}, "birth": {"date": {"label": "2 June 1980"}}},
]

PLAYERS = [
    {"playerId": 338798.0, "info": {"position": "D", "shirtNum": 4.0, "positionInfo": "Central Defender/Midfielder"},
     "nationalTeam": COUNTRY, **person("Eve", "E", "31 March 1998")},
    {"playerId": 2.0, "info": {"position": "M", "positionInfo": "Midfielder"}, "nationalTeam": COUNTRY,
     **person("No", "Birth")},
    {"playerId": 3.0, "info": {"position": "M"}, "nationalTeam": COUNTRY, **person("No", "Position", "1 May 1999")},
    {"playerId": 4.0, "info": {"position": "M", "positionInfo": "Midfielder"}, **person("No", "Country", "2 May 1999")},
]


def player_stat(name, player_id, value, club_id=None):
    owner = {"playerId": float(player_id)}
    if club_id is not None:
        owner["currentTeam"] = {"club": {"id": float(club_id)}}
    return {"name": name, "value": value, "owner": owner}


PLAYER_STATS = [
    {"entity": "goals", "stats": [player_stat("goals", 4, 3.0, 1), player_stat("goals", 5, 1.0)]},
    {"entity": "goals", "stats": [player_stat("goals", 4, 2.0, 1)]},
    {"entity": "saves", "stats": [player_stat("saves", 4, 6.0, 2)]},
    {"entity": "touches", "stats": [player_stat("touches", 6, 8.0, 1)]},
]


def award(i, name, **extra):
    return {"awardTypeId": float(i), "award": name, **extra}


PROMO = {"type": "PROMO", "reference": "p1"}
TEXT = {"type": "TEXT", "reference": "t1"}
MONTH_AWARD = {
    "August": [
        award(1, "Player of the Month", player={"playerId": 4.0}, relatedContent=[PROMO, TEXT]),
        award(2, "Manager of the Month", official={"officialId": 7.0}, relatedContent=[TEXT]),
    ],
    "September": [award(1, "EA Player of the Month", player={"playerId": 4.0}, official={"officialId": 7.0})],
    "October": [],
}
SEASON_AWARD = [
    award(3, "Champions", apiTeam={"id": 1.0}, relatedContent=[TEXT, PROMO]),
    award(4, "Golden Boot", player={"playerId": 338798.0}),
]


def match(i, teams, kickoff, clock, attendance=100.5):
    return {
        "id": float(i),
        "teams": [{"team": {"id": float(t)}, "score": s} for t, s in teams],
        "kickoff": {"label": kickoff},
        "attendance": attendance,
        "gameweek": {"gameweek": 3.0},
        "clock": {"label": clock, "secs": 5700.0},
        "ground": {"id": 10.0},
    }


MATCHES = [
    match(75281, [(1, 2.0), (38, 1.0)], "Sat 12 Aug 2023, 15:00 BST", "90 +5'00"),
    match(75291, [(1, 0.0)], "Mon 26 Dec 2022, 20:00 GMT", "45"),
    match(75301, [(1, 0.0), (2, 0.0)], "Sun 29 Oct 2023, 01:30", None),
    match(75311, [(1, 0.0), (2, 0.0)], None, "90 +5'12"),
]

# fixed values: 12 rows (club, match, name, value)
MATCH_VALUES = [
    (1, 75281, "formation_used", 433.0), (1, 75281, "fk_foul_lost", 8.0), (1, 75281, "duel_lost", 45.0),
    (38, 75281, "formation_used", 433.0), (38, 75281, "fk_foul_lost", 9.0), (38, 75281, "duel_lost", 35.0),
    (1, 75291, "formation_used", 433.0), (1, 75291, "fk_foul_lost", 2.0), (1, 75291, "duel_lost", 15.0),
    (38, 75291, "formation_used", 442.0), (38, 75291, "fk_foul_lost", 11.0), (38, 75291, "duel_lost", 25.0),
]


def match_stats():
    documents = {}
    for club_id, match_id, name, value in MATCH_VALUES:
        document = documents.setdefault(
            match_id,
            {"entity": {"id": float(match_id), "teams": [{"team": {"id": 1.0}}, {"team": {"id": 38.0}}]}, "stats": {}},
        )
        document["stats"].setdefault(str(club_id), {"M": []})["M"].append(
            {"name": name, "value": value, "description": f"Todo: {name}"}
        )
    for document in documents.values():
        document["stats"]["999"] = {"M": [{"name": "duel_lost", "value": 1.0, "description": ""}]}
    return list(documents.values())


def land(root: str) -> None:
    """Season 2023-24 holds everything, 2022-23 the first club and empty files."""

    def write(path, body):
        full = os.path.join(root, path)
        os.makedirs(os.path.dirname(full), exist_ok=True)
        with open(full, "w", encoding="utf-8") as out:
            json.dump(body, out, indent=2)

    write("season/seasons.json", SEASONS)
    full = {
        "club/{s}/club_info.json": CLUB_INFO,
        "club/{s}/club_stats.json": CLUB_STATS,
        "player/{s}/player_info.json": PLAYERS,
        "player/{s}/player_stats.json": PLAYER_STATS,
        "manager/{s}/manager_info.json": MANAGERS,
        "award/{s}/month/award.json": MONTH_AWARD,
        "award/{s}/season/award.json": SEASON_AWARD,
        "match/{s}/match_info.json": MATCHES,
        "match/{s}/match_stats.json": match_stats(),
    }
    for path, body in full.items():
        write(path.format(s="2023-24"), body)
        write(path.format(s="2022-23"), {} if isinstance(body, dict) else [])
    write("club/2022-23/club_info.json", [{**club(1, grounds=[ground(10)]), "name": "Old Club 1"}])
