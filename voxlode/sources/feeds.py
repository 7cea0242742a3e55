"""Landed API payloads to flat rows: one spec per payload shape.

Input rows carry the raw JSON in ``payload`` and the request context (such as ``app_id``, ``app_name``,
``package``, ``keyword``, ``permalink``, ``topic_id``) in columns of their own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import trim_all


def iso_of_epoch(c: Column) -> Column:
    """Epoch seconds to ISO text in UTC; 0 and null give an empty text."""
    shown = F.date_format(F.timestamp_seconds(c.cast("double")), "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.coalesce(c.cast("double"), F.lit(0.0)) == 0, "").otherwise(shown)


def text_or(c: Column, default: str = "") -> Column:
    return F.coalesce(c.cast("string"), F.lit(default))


def count_or_zero(c: Column) -> Column:
    return F.coalesce(c.cast("int"), F.lit(0))


def without_tags(c: Column, gap: str = "") -> Column:
    return F.regexp_replace(text_or(c), "<[^>]+>", gap)


@dataclass(frozen=True)
class Feed:
    """``schema`` of the payload, path to the ``items`` array, output ``row``, and which items to ``keep``."""

    schema: str
    items: Callable[[Column], Column]
    row: Callable[[Callable[[str], Column]], dict[str, Column]]
    keep: Callable[[Callable[[str], Column]], Column] | None = None


def link(head: str, c: Column, tail: str = "") -> Column:
    return F.concat(F.lit(head), text_or(c), F.lit(tail))


_LABEL = "struct<label:string>"

# Field names and link forms of the public feeds.
FEEDS: dict[str, Feed] = {
    "store_rss": Feed(
        f"feed struct<entry:array<struct<author:struct<name:{_LABEL}>,`im:rating`:{_LABEL},title:{_LABEL},content:{_LABEL},`im:version`:{_LABEL},updated:{_LABEL}>>>",
        lambda p: p["feed"]["entry"],
        lambda f: {
            "author": text_or(f("author.name.label")),
            "rating": count_or_zero(f("`im:rating`.label")),
            "title": text_or(f("title.label")),
            "content": text_or(f("content.label")),
            "version": text_or(f("`im:version`.label")),
            "date": text_or(f("updated.label")),
            "source": F.lit("App Store"),
            "url": link("https://apps.apple.com/us/app/id", F.col("app_id"), "?see-all=reviews"),
        },
        # The first entry describes the app and has no rating.
        lambda f: f("`im:rating`").isNotNull(),
    ),
    "forum_hits": Feed(
        "hits array<struct<objectID:string,author:string,comment_text:string,created_at:string,points:int,story_id:string,story_title:string,story_url:string>>",
        lambda p: p["hits"],
        lambda f: {
            "id": text_or(f("objectID")),
            "author": text_or(f("author"), "anonymous"),
            "content": F.trim(F.regexp_replace(without_tags(f("comment_text"), " "), r"\s+", " ")),
            "created_at": text_or(f("created_at")),
            "points": count_or_zero(f("points")),
            "story_id": text_or(f("story_id")),
            "story_title": text_or(f("story_title")),
            "story_url": text_or(f("story_url")),
            "source_url": link("https://news.ycombinator.com/item?id=", f("objectID")),
            "source": F.lit("Hacker News"),
        },
    ),
    "listing_posts": Feed(
        "data struct<children:array<struct<data:struct<id:string,author:string,title:string,selftext:string,score:int,num_comments:int,created_utc:double,permalink:string>>>>",
        lambda p: p["data"]["children"],
        lambda f: {
            "id": text_or(f("data.id")),
            "type": F.lit("post"),
            "author": text_or(f("data.author"), "[deleted]"),
            "title": text_or(f("data.title")),
            "content": text_or(f("data.selftext")),
            "score": count_or_zero(f("data.score")),
            "num_comments": count_or_zero(f("data.num_comments")),
            "date": iso_of_epoch(f("data.created_utc")),
            "source": F.lit("Reddit"),
            "source_url": link("https://reddit.com", f("data.permalink")),
        },
    ),
    "comment_tree": Feed(
        # The payload is a list: the post first, its comments second.
        "array<struct<data:struct<children:array<struct<kind:string,data:struct<id:string,author:string,body:string,score:int,created_utc:double>>>>>>",
        lambda p: F.get(p, 1)["data"]["children"],
        lambda f: {
            "id": text_or(f("data.id")),
            "type": F.lit("comment"),
            "author": text_or(f("data.author"), "[deleted]"),
            "content": text_or(f("data.body")),
            "score": count_or_zero(f("data.score")),
            "date": iso_of_epoch(f("data.created_utc")),
            "source": F.lit("Reddit"),
            "source_url": link("https://reddit.com", F.col("permalink")),
        },
        lambda f: (f("kind") == "t1") & ~F.coalesce(f("data.body"), F.lit("")).isin("", "[deleted]"),
    ),
    "topic_list": Feed(
        "array<struct<id:string,title:string,content:string,member:struct<username:string>,replies:int,created:double,url:string>>",
        lambda p: p,
        lambda f: {
            "id": text_or(f("id")),
            "title": text_or(f("title")),
            "content": text_or(f("content")),
            "author": text_or(f("member.username")),
            "replies": count_or_zero(f("replies")),
            "date": iso_of_epoch(f("created")),
            "source": F.lit("V2EX"),
            "source_url": text_or(f("url")),
        },
    ),
    "topic_replies": Feed(
        "array<struct<id:string,content:string,member:struct<username:string>,created:double>>",
        lambda p: p,
        lambda f: {
            "id": text_or(f("id")),
            "content": text_or(f("content")),
            "author": text_or(f("member.username")),
            "date": iso_of_epoch(f("created")),
            "source": F.lit("V2EX"),
            "source_url": link("https://www.v2ex.com/t/", F.col("topic_id")),
        },
    ),
    "complaint_list": Feed(
        "result struct<data:struct<lists:array<struct<main:struct<title:string,summary:string,cotitle:string,status_desc:string,timestamp:string,appeal:string,sn:string>>>>>",
        lambda p: p["result"]["data"]["lists"],
        lambda f: {
            "title": text_or(f("main.title")),
            "summary": text_or(f("main.summary")),
            "company": text_or(f("main.cotitle")),
            "status": text_or(f("main.status_desc")),
            "timestamp": text_or(f("main.timestamp")),
            "appeal": text_or(f("main.appeal")),
            "url": link("https://tousu.sina.com.cn/complaint/view/", f("main.sn"), "/"),
            "source": F.lit("complaints"),
        },
    ),
    "answer_list": Feed(
        "data array<struct<id:string,content:string,excerpt:string,author:struct<name:string>,voteup_count:int,comment_count:int,created_time:double>>",
        lambda p: p["data"],
        lambda f: {
            "id": text_or(f("id")),
            "content": F.substring(trim_all(without_tags(f("content"))), 1, 2000),
            "excerpt": text_or(f("excerpt")),
            "author": text_or(f("author.name"), "anonymous"),
            "voteup_count": count_or_zero(f("voteup_count")),
            "comment_count": count_or_zero(f("comment_count")),
            "date": iso_of_epoch(f("created_time")),
            "source": F.lit("answers"),
        },
        lambda f: F.length(trim_all(without_tags(f("content")))) >= 20,
    ),
    "answer_search": Feed(
        "data array<struct<object:struct<id:string,type:string,content:string,author:struct<name:string>,voteup_count:int>>>",
        lambda p: p["data"],
        lambda f: {
            "id": text_or(f("object.id")),
            "type": F.lit("answer"),
            "content": F.substring(without_tags(f("object.content")), 1, 1000),
            "author": text_or(f("object.author.name")),
            "voteup_count": count_or_zero(f("object.voteup_count")),
            "source": F.lit("answer search"),
        },
        lambda f: f("object.type") == "answer",
    ),
    "app_feed": Feed(
        "data array<struct<entityType:string,id:string,message:string,username:string,likenum:int,replynum:int,score:int,device_title:string,dateline:string>>",
        lambda p: p["data"],
        lambda f: {
            "id": text_or(f("id")),
            "content": text_or(f("message")),
            "author": text_or(f("username")),
            "like_count": count_or_zero(f("likenum")),
            "reply_count": count_or_zero(f("replynum")),
            "rating": count_or_zero(f("score")),
            "device": text_or(f("device_title")),
            "date": text_or(f("dateline")),
            "source": F.lit("app feed"),
            "source_url": link("https://www.coolapk.com/apk/", F.col("package")),
        },
        lambda f: (f("entityType") == "feed") & (F.length(text_or(f("message"))) >= 10),
    ),
    "play_reviews": Feed(
        "array<struct<reviewId:string,userName:string,score:int,content:string,at:string,thumbsUpCount:int,replyContent:string>>",
        lambda p: p,
        lambda f: {
            "id": text_or(f("reviewId")),
            "author": text_or(f("userName"), "anonymous"),
            "rating": count_or_zero(f("score")),
            "content": text_or(f("content")),
            "date": text_or(f("at")),
            "thumbs_up": count_or_zero(f("thumbsUpCount")),
            "reply_content": text_or(f("replyContent")),
            "source": F.lit("Google Play"),
            "source_url": link("https://play.google.com/store/apps/details?id=", F.col("package")),
        },
    ),
    "play_snippets": Feed(
        "reviews array<struct<author:string,rating:int,title:string,snippet:string,date:string>>",
        lambda p: p["reviews"],
        lambda f: {
            "author": text_or(f("author")),
            "rating": count_or_zero(f("rating")),
            "title": text_or(f("title")),
            "content": text_or(f("snippet")),
            "date": text_or(f("date")),
            "source": F.lit("Google Play"),
            "url": link("https://play.google.com/store/apps/details?id=", F.col("package")),
        },
    ),
    "note_list": Feed(
        "search struct<notes:struct<items:array<struct<note:struct<id:string,title:string,desc:string,user:struct<nickname:string>,liked_count:int,comments_count:int>>>>>",
        lambda p: p["search"]["notes"]["items"],
        lambda f: {
            "id": text_or(f("note.id")),
            "title": text_or(f("note.title")),
            "content": text_or(f("note.desc")),
            "author": text_or(f("note.user.nickname")),
            "likes": count_or_zero(f("note.liked_count")),
            "comments": count_or_zero(f("note.comments_count")),
            "source": F.lit("notes"),
            "source_url": link("https://www.xiaohongshu.com/explore/", f("note.id")),
        },
    ),
}


def flatten_feed(landed: DataFrame, kind: str, payload: str = "payload") -> DataFrame:
    """Flat rows of a landed payload; unreadable payloads give none.  Context columns stay in front."""
    feed = FEEDS[kind]
    context = [c for c in landed.columns if c != payload]
    parsed = F.from_json(payload, feed.schema)
    rows = landed.select(*context, F.explode(feed.items(parsed)).alias("_i"))

    def field(path: str) -> Column:
        return F.col(f"_i.{path}")

    if feed.keep is not None:
        rows = rows.filter(F.coalesce(feed.keep(field), F.lit(False)))
    return rows.select(*context, *[v.alias(k) for k, v in feed.row(field).items()])
