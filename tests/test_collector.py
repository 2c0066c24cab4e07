"""The collector run: replays change nothing, bad input of one platform does not stop the others."""
from castline.operators import collector as cl
from castline.operators import maintain as mn
from tests.conftest import rows

CHANNEL = '{"items":[{"id":"UC%s","snippet":{"description":"d"}}]}'
VIDEOS = '{"items":[{"id":{"videoId":"%s"},"snippet":{"title":"t","description":"d","publishedAt":"2024-01-05T10:00:00Z"}}]}'
REPORT = '{"rows":[["2024-01-05",%d,1,0,2,3,40,50,6,7],["bad",1,1,1,1,1,1,1,1,1]]}'
THREADS = ('{"items":[{"id":"c1","snippet":{"totalReplyCount":1,"topLevelComment":{"snippet":{"textDisplay":"hi",'
           '"authorDisplayName":"a","likeCount":2,"publishedAt":"2024-01-06T08:00:00Z"}}}}]}')


def landed(spark, views=10):
    def of(data, key):
        return spark.createDataFrame(data, f"platform string, {key}, payload string")
    return {
        "channels": of([("youtube", 1, CHANNEL % 1), ("spotify", 2, "{oops"), ("apple", 3, CHANNEL % 3), ("apple", 4, '{"items":[]}')],
                       "podcast_id bigint"),
        "videos": of([("youtube", 1, VIDEOS % "v1"), ("spotify", 2, VIDEOS % "v2"), ("apple", 3, "nonsense"), ("youtube", None, None)],
                     "podcast_id bigint"),
        "reports": of([("youtube", "v1", REPORT % views), ("youtube", "v9", REPORT % 1)], "video_id string"),
        "show_reports": of([("apple", 3, '{"rows":[["2024-01-05",1,2,3,4,5,6,7]]}')], "podcast_id bigint"),
        "threads": of([("youtube", "v1", THREADS), ("spotify", "v2", THREADS)], "video_id string"),
    }


def state(run):
    return {t: rows(run.table(t)) for t in ("raw_podcasts", "raw_podcast_episodes", "raw_podcast_episode_metrics",
                                            "raw_podcast_show_metrics", "raw_podcast_comments", "quarantine",
                                            "raw_podcast_scraper_runs")}


def test_collect_loads_quarantines_and_logs(spark, tmp_path):
    root = str(tmp_path / "c")
    run = cl.collect(spark, landed(spark), root, "2024-02-01 02:00:00", buckets=2)
    first = state(run)
    assert {k: len(v) for k, v in first.items()} == {
        "raw_podcasts": 2, "raw_podcast_episodes": 1, "raw_podcast_episode_metrics": 1, "raw_podcast_show_metrics": 1,
        "raw_podcast_comments": 1, "quarantine": 9, "raw_podcast_scraper_runs": 3}
    log = {r["platform"]: (r["status"], r["episodes_processed"], r["metrics_collected"])
           for r in run.table("raw_podcast_scraper_runs").collect()}
    assert log == {"youtube": ("completed", 1, 1), "apple": ("completed", 0, 1), "spotify": ("failed", 0, 0)}
    assert state(cl.collect(spark, landed(spark), root, "2024-02-01 02:00:00", buckets=2)) == first

    later = cl.collect(spark, landed(spark, views=77), root, "2024-02-02 02:00:00", buckets=2)
    metrics = mn.read_table(spark, f"{root}/raw_podcast_episode_metrics").first()
    assert (metrics["views"], str(metrics["created_at"])[:10], str(metrics["updated_at"])[:10]) == (77, "2024-02-01", "2024-02-02")
    assert later.table("raw_podcast_scraper_runs").count() == 6 and later.table("raw_podcasts").count() == 2
