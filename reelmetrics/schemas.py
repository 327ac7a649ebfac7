"""Explicit schemas (DDL) of the domain tables and of the nested API responses."""

from __future__ import annotations

COMMENT = (
    "struct<id:string,snippet:struct<authorDisplayName:string,textDisplay:string,"
    "likeCount:bigint,publishedAt:string>>"
)

SEARCH_RESPONSE = (
    "query string, regionCode string, language string, market_no bigint, query_no bigint, page_no bigint,"
    "nextPageToken string,"
    "items array<struct<id:struct<videoId:string>,snippet:struct<publishedAt:string>>>"
)
VIDEO_RESPONSE = (
    "page_no bigint, items array<struct<id:string,"
    "snippet:struct<channelId:string,title:string,description:string,channelTitle:string,publishedAt:string>,"
    "statistics:struct<viewCount:string,likeCount:string,commentCount:string>,"
    "contentDetails:struct<duration:string>>>"
)
CHANNEL_RESPONSE = (
    "page_no bigint, items array<struct<id:string,snippet:struct<description:string,country:string>,"
    "statistics:struct<subscriberCount:string,videoCount:string,viewCount:string,"
    "hiddenSubscriberCount:boolean>>>"
)
COMMENT_THREAD = (
    f"videoId string, snippet struct<topLevelComment:{COMMENT}>, replies struct<comments:array<{COMMENT}>>"
)

VIDEOS = (
    "videoId string, channelId string, title string, description string, channelTitle string,"
    "publishedAt string, duration string, market string, search_query string, language_hint string,"
    "viewCount double, likeCount double, commentCount double, dislikeCount double,"
    "channelDescription string, channelCountry string, subscriberCount double,"
    "channelVideoCount double, channelViewCount double, hiddenSubscriberCount boolean"
)
TRANSCRIPTS = "videoId string, language string, text string"
COMMENTS = (
    "videoId string, commentId string, author string, text string, likeCount bigint,"
    "publishedAt string, isReply boolean, replyTo string"
)
COMMENTS_SPAM = (
    "videoId string, commentId string, author string, text string, likeCount bigint,"
    "publishedAt string, isReply boolean, replyTo string,"
    "spam_score int, spam_signals string, spam_label string"
)
